"""Indicator inputs: the raw landing area (Hive-partitioned JSON) and the
clean indicator table (immutable Parquet snapshots + a commit log)."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.schemas import CLEAN_IOC_SCHEMA, RAW_IOC_TEXT_DOCUMENT
from tidewatch.sinks.keyed import KeyedTable

RAW_SCHEMA = T.StructType(
    RAW_IOC_TEXT_DOCUMENT.fields
    + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()), T.StructField("day", T.IntegerType())]
)
COMMITS = "_commits"
SNAPSHOTS = "snapshots"
COMMIT_SCHEMA = T.StructType([
    T.StructField("snapshot", T.StringType()),
    T.StructField("marker", T.DateType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("version", T.LongType()),
])


def folder_date() -> Column:
    """Landing day from the partition columns; a malformed folder gives null
    (make_date would fail the job under ANSI)."""
    text = F.concat_ws("-", F.col("year").cast("string"), F.col("month").cast("string"), F.col("day").cast("string"))
    return F.to_date(F.try_to_timestamp(text, F.lit("y-M-d")))


def read_raw(spark: SparkSession, base: str, after: dt.date | None = None, inclusive: bool = True) -> DataFrame:
    """Raw feed documents with `folder_date` (null for a folder that names no
    day), their indicators as JSON text; only days from `after` on (after it,
    with `inclusive=False`) and folders without a day, which any run may find.

    The day filter references partition columns only, so it is applied to
    the directory listing (PartitionFilters): skipped days are never opened.
    """
    raw = spark.read.schema(RAW_SCHEMA).json(base).withColumn("folder_date", folder_date())
    if after is not None:
        day = F.col("folder_date")
        raw = raw.filter((day >= F.lit(after) if inclusive else day > F.lit(after)) | day.isNull())
    return raw


def raw_stream(spark: SparkSession, base: str, max_files: int | None = None) -> DataFrame:
    """The landing area as a stream of raw feed documents, each file once, in
    the order in which files land; whole folders may appear late."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("maxFileAge", "36500d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(base)


def read_commits(spark: SparkSession, table: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMIT_SCHEMA).json(f"{table}/{COMMITS}")
    except AnalysisException as e:  # only a missing log means "new table"
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def last_commit(spark: SparkSession, table: str):
    """Latest commit row (version, snapshot, marker) or None for a new table."""
    commits = read_commits(spark, table)
    if commits is None:
        return None
    return commits.orderBy(F.col("version").desc()).select("version", "snapshot", "marker").first()


def read_marker(spark: SparkSession, table: str) -> dt.date | None:
    """Last landing day merged into the table; None means never run."""
    c = last_commit(spark, table)
    return None if c is None else c["marker"]


def read_iocs(spark: SparkSession, table: str) -> DataFrame | None:
    """The current clean indicator table, of either layout (None if nothing was
    committed)."""
    keyed = KeyedTable(spark, table, CLEAN_IOC_SCHEMA, "id", F.lit(None))
    if keyed.versions():
        return keyed.read()
    c = last_commit(spark, table)
    if c is None:
        return None
    return spark.read.schema(CLEAN_IOC_SCHEMA).parquet(f"{table}/{SNAPSHOTS}/{c['snapshot']}")
