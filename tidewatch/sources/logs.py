"""Network-log sources: decoding sensor JSON into wide rows, and the batch /
streaming inputs that carry it (Kafka topic, or files of JSON lines)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.schemas import ID_RENAMES, WIDE_SCHEMA, WIRE_SCHEMA

# Fixed value: the sensor's timestamp text format (microseconds, zone letter).
SENSOR_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"
WIRE_NAMES = {v: k for k, v in ID_RENAMES.items()}


# Wire fields the detectors read; decoding only these skips building the
# other 56 columns per record (Catalyst does not prune a from_json schema
# that carries options such as the timestamp format).
DETECTOR_FIELDS = ("ts", "uid", "id.orig_h", "id.resp_h", "id.resp_p", "orig_bytes", "query", "answers", "host")


def decode_logs(df: DataFrame, value: str | Column = "value", fields: tuple[str, ...] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sensor JSON text (or Kafka bytes) -> wide rows with flat names.

    PERMISSIVE parsing: malformed text or a bad field yields nulls, never a
    failed job or a stopped stream. `fields` limits decoding to those wire
    fields (default: all 65); `keep` names input columns to carry along.
    """
    v = F.col(value) if isinstance(value, str) else value
    schema = WIRE_SCHEMA if fields is None else T.StructType([f for f in WIRE_SCHEMA.fields if f.name in fields])
    parsed = F.from_json(v.cast("string"), schema, {"timestampFormat": SENSOR_TIME_FORMAT, "mode": "PERMISSIVE"})
    return df.select(parsed.alias("_d"), *keep).select("_d.*", *keep).withColumnsRenamed(
        {k: v for k, v in ID_RENAMES.items() if k in schema.fieldNames()})


def conform_wide(df: DataFrame, path_col: str = "log_path", keep: tuple[str, ...] = ()) -> DataFrame:
    """Project any log-shaped frame onto `WIDE_SCHEMA` (absent columns are
    typed nulls; `path_col` fills `@path`; `keep` is carried along)."""
    present = set(df.columns)
    cols = []
    for f in WIDE_SCHEMA.fields:
        name = f.name
        if name in present:
            cols.append(F.col(f"`{name}`").cast(f.dataType).alias(name))
        elif name == "@path" and path_col in present:
            cols.append(F.col(path_col).cast(f.dataType).alias(name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(name))
    return df.select(*cols, *keep)


def encode_logs(df: DataFrame) -> DataFrame:
    """Wide rows -> sensor JSON text in `value` (dotted names, null fields
    omitted), the wire form a sensor publishes."""
    wide = conform_wide(df)
    fields = [F.col(f"`{n}`").alias(WIRE_NAMES.get(n, n)) for n in wide.columns]
    return wide.select(
        F.to_json(F.struct(*fields), {"timestampFormat": SENSOR_TIME_FORMAT}).alias("value")
    )


def with_event_time(df: DataFrame, delay: str = "5 seconds") -> DataFrame:
    """Event-time watermark on `ts` (an NTZ column is cast to timestamp first,
    watermarks reject NTZ)."""
    if isinstance(df.schema["ts"].dataType, T.TimestampNTZType):
        df = df.withColumn("ts", F.col("ts").cast(T.TimestampType()))
    return df.withWatermark("ts", delay)


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets: int | None = None,
    starting: str = "latest",
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Raw log records from a Kafka topic (needs the Kafka connector jar).

    By default nothing is skipped: every trigger takes what has arrived, and a
    gap left by retention fails the query. `max_offsets` caps a trigger; a
    feed faster than the cap falls behind.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Raw log records from files of JSON lines landing in `path`, oldest
    files first, at most `max_files` a micro-batch."""
    reader = spark.readStream.format("text").schema("value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_logs(spark: SparkSession, path: str, fields: tuple[str, ...] | None = None) -> DataFrame:
    """Batch read of JSON-lines log files, decoded like the stream."""
    return decode_logs(spark.read.format("text").load(path), fields=fields)
