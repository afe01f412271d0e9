"""Sinks: alert JSON records, typed document rows for the log and alert
indexes, and the raw indicator landing area."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.schemas import ALERT_SCHEMA, RAW_IOC_TEXT_DOCUMENT, RAW_PARTITIONS, WIDE_SCHEMA
from tidewatch.sources.logs import conform_wide, decode_logs


def alert_json(alerts: DataFrame) -> DataFrame:
    """Alert rows -> (key, value) records: key = alert id, value = JSON text.
    Null fields are left out of the JSON; empty arrays stay."""
    return alerts.select(
        F.col("alert_id").alias("key"),
        F.to_json(F.struct(*[F.col(f.name) for f in ALERT_SCHEMA.fields])).alias("value"),
    )


def decode_alerts(records: DataFrame, value: str = "value") -> DataFrame:
    """Alert JSON text -> typed alert rows; a missing field reads as null."""
    return records.select(F.from_json(F.col(value).cast("string"), ALERT_SCHEMA).alias("_a")).select("_a.*")


def alert_documents(alerts: DataFrame) -> DataFrame:
    """Typed alert documents keyed by `alert_id` (idempotent upsert key)."""
    return alerts.select(F.col("alert_id").alias("doc_id"), *[F.col(f.name).cast(f.dataType) for f in ALERT_SCHEMA.fields])


def _record_json() -> Column:
    """A wide row as JSON, null fields left out, times in microseconds."""
    return F.to_json(F.struct(*[
        F.unix_micros(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
        for f in WIDE_SCHEMA.fields]))


def log_documents(logs: DataFrame) -> DataFrame:
    """Typed log documents (65 wide fields) keyed by the whole record: the
    hash of its JSON form, times in microseconds. A record delivered twice is
    one document; records that differ in any field are two."""
    wide = conform_wide(logs)
    return wide.select(F.sha2(_record_json(), 256).alias("doc_id"), *[F.col(f"`{f.name}`") for f in WIDE_SCHEMA.fields])


def raw_log_documents(records: DataFrame, value: str = "value") -> DataFrame:
    """Log documents of raw records. Text that decodes to nothing becomes a
    document keyed by that text, which `raw_text` keeps."""
    text = F.col(value).cast("string")
    rows = decode_logs(records.withColumn("_text", text), "_text", keep=("_text",))
    wide = [f"`{f.name}`" for f in WIDE_SCHEMA.fields]
    empty = F.coalesce(*[F.col(c).cast("string") for c in wide]).isNull()
    kept = conform_wide(rows, keep=("_text",))
    key = F.sha2(F.when(empty, F.concat(F.lit("text:"), "_text")).otherwise(_record_json()), 256)
    return kept.select(key.alias("doc_id"), *[F.col(c) for c in wide], F.when(empty, F.col("_text")).alias("raw_text"))


def land_raw(documents: DataFrame, base: str) -> None:
    """Append raw feed documents under `base/year=YYYY/month=MM/day=DD/`.

    Documents without indicators are skipped (an empty pull writes nothing).
    """
    keep = documents.filter(F.col("data").isNotNull() & (F.size("data") > 0))
    if documents.schema["data"].dataType == T.ArrayType(T.StringType()):  # indicators as JSON text
        status = F.coalesce(F.to_json(F.struct("query_status")), F.lit("{}"))
        body = F.concat(F.expr("substring(s, 1, length(s) - 1)"), F.when(F.col("s") == "{}", "").otherwise(","), F.lit('"data":['), F.array_join("data", ","), F.lit("]}"))
        lines = keep.withColumn("s", status).withColumn("value", body)
        _partitioned(lines, "value").write.mode("append").partitionBy(*RAW_PARTITIONS).text(base)
        return
    _partitioned(keep, "query_status", "data").write.mode("append").partitionBy(*RAW_PARTITIONS).json(base)


def _partitioned(documents: DataFrame, *columns: str) -> DataFrame:
    return documents.select(
        *columns,
        F.col("year").cast("int").alias("year"),
        F.lpad(F.col("month").cast("string"), 2, "0").alias("month"),
        F.lpad(F.col("day").cast("string"), 2, "0").alias("day"),
    )


def land_pulls(spark: SparkSession, pulls: str, base: str, day: dt.date) -> None:
    """Land payload files as they were pulled, one JSON document a file, under
    the day's folder; documents without indicators are skipped."""
    text = spark.read.option("wholetext", True).text(pulls)
    docs = text.select(F.from_json("value", RAW_IOC_TEXT_DOCUMENT).alias("d")).select("d.*")
    land_raw(docs.withColumns({"year": F.lit(day.year), "month": F.lit(day.month), "day": F.lit(day.day)}), base)


def ensure_table(spark, path: str, schema) -> None:
    """Create an empty Parquet table with `schema` if `path` holds none;
    if it exists, fail unless every declared column is there with its type
    (a document table is created once and then only appended to)."""
    from pyspark.errors import AnalysisException

    try:
        existing = spark.read.parquet(path).schema
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
        return
    have = {f.name: f.dataType for f in existing.fields}
    wrong = [f.name for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"table at {path} does not match the mapping for columns {wrong}")
