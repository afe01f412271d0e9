"""Corpus pipeline: from raw documents to a weighted training set.

STAGES names the stages in order. Each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and reread as the next
one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.decontaminate import decontaminated
from tidewatch.llm.domain_mix import mixed
from tidewatch.llm.lines import without_repeated_lines
from tidewatch.llm.neardup import one_per_class
from tidewatch.llm.quality import classified
from tidewatch.llm.textkit import package_on_workers, read, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    package_on_workers(spark)
    return classified(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut from the texts; n_chars follows."""
    package_on_workers(spark)
    from pyspark.sql import functions as F

    cut = without_repeated_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    package_on_workers(spark)
    return one_per_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    package_on_workers(spark)
    return decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets the rate that brings the domains to their targets."""
    package_on_workers(spark)
    return mixed(docs, read(spark, sf_dir, "labels"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
]

#: The quality classifier and the near-dup sampling have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and reread."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        path = scratch(spark, "pipeline-" + name.split()[0].lower())
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
