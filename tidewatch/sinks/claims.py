"""Files that exist whole or not at all, created by one writer only."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another run committed this version first; nothing of this run is visible."""


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file `path` holding `text`; False if it exists already.

    The text goes to a draft first, which then takes the name in one step that
    fails where the name is taken: a hard link on a local file system, a rename
    without overwriting elsewhere. Of any number of writers one gets True, and
    no reader ever sees a part of the text.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, fs = _at(spark, path)
    target = fs.makeQualified(target)
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if target.toUri().getScheme() == "file":
            name = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(name(target), name(draft))
        else:
            how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            how[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, how)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(draft, False)
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    at, fs = _at(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """(name, modification time in seconds) of a folder's entries; none if it is missing."""
    at, fs = _at(spark, folder)
    if not fs.exists(at):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(at) if not s.getPath().getName().startswith((".", "_"))]


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)
