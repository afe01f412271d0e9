"""Structured Streaming wiring: log stream -> detectors -> alert sink.

One query per run: decode, watermark on event time, the three detectors
(the two pair detectors in one stateful aggregation), union, sink. State and
progress live in the query's own checkpoint folder on the shared file system,
so a lost executor or a restarted driver resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.detect import DEFAULT, SALT_BUCKETS, Thresholds, alerts, alerts_one_scan, ioc_match, pair_activity
from tidewatch.operators.iocs import MatchKeys, prepared_keys
from tidewatch.sinks.outputs import alert_documents, alert_json, decode_alerts, ensure_table, raw_log_documents
from tidewatch.sources.iocs import read_iocs
from tidewatch.sources.logs import DETECTOR_FIELDS, decode_logs, with_event_time
from tidewatch.streaming.metrics import observed

WATERMARK = "5 seconds"
TRIGGER = "15 seconds"
REFRESH_SECONDS = 3 * 60 * 60
#: Event time within which a document stream drops redelivered records.
REDELIVERY = "1 hour"


def detection_stream(
    records: DataFrame,
    iocs: DataFrame | None,
    detectors: tuple[str, ...] = ("ioc", "scan", "exfil"),
    exact: bool = True,
    watermark: str = WATERMARK,
    t: Thresholds = DEFAULT,
    keys: MatchKeys | None = None,
    salt_buckets: int = SALT_BUCKETS,
    strict_keys: bool = False,
    one_scan: bool = False,
) -> DataFrame:
    """Raw log records (`value` column) -> alert rows, as a stream. A
    stream-static join evaluates its static side every trigger; the
    indicators are folded once (`keys`, or here) and read from files.
    `one_scan`: all three detectors from one read of each micro-batch and one
    state store, IOC alerts up to a pair window later, and counts of records
    that decode to nothing (streaming/metrics.py). It is a setting of a
    checkpoint: the two forms keep different state."""
    if one_scan:
        if set(detectors) != {"ioc", "scan", "exfil"}:
            raise ValueError("one_scan runs all three detectors")
        logs = with_event_time(observed(decode_logs(records, fields=DETECTOR_FIELDS)), watermark)
        return alerts_one_scan(logs, iocs, exact, t, keys=keys, salt_buckets=salt_buckets, strict_keys=strict_keys)
    logs = with_event_time(decode_logs(records, fields=DETECTOR_FIELDS), watermark)
    pair_kinds = tuple(k for k in ("scan", "exfil") if k in detectors)
    if "ioc" in detectors and pair_kinds == ("scan", "exfil"):
        return alerts(logs, iocs, exact, t, keys=keys, salt_buckets=salt_buckets, strict_keys=strict_keys)
    out = None
    if "ioc" in detectors:
        out = ioc_match(logs, iocs, t, keys=keys, salt_buckets=salt_buckets, strict_keys=strict_keys)
    if pair_kinds:
        pa = pair_activity(logs, pair_kinds, exact, t)
        out = pa if out is None else out.unionByName(pa)
    return out


def start_sink(
    alerts_df: DataFrame,
    checkpoint: str,
    fmt: str = "parquet",
    path: str | None = None,
    options: dict[str, str] | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the alert sink in append mode.

    `fmt="kafka"` writes (key, value) JSON records (options carry servers
    and topic); file formats write typed alert rows with exactly-once commit.
    """
    out = alert_json(alerts_df) if fmt == "kafka" else alerts_df
    w = out.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.trigger(**(trigger or {"processingTime": TRIGGER}))
    if name:
        w = w.queryName(name)
    return w.start(path) if path else w.start()


def run_detection(
    spark: SparkSession,
    source: Callable[[SparkSession], DataFrame],
    ioc_table: str,
    checkpoint: str,
    fmt: str = "parquet",
    path: str | None = None,
    options: dict[str, str] | None = None,
    trigger: dict | None = None,
    refresh_seconds: float = REFRESH_SECONDS,
    cycles: int | None = None,
    exact: bool = True,
    salt_buckets: int = SALT_BUCKETS,
    strict_keys: bool = False,
    one_scan: bool = False,
) -> None:
    """Run detection, reloading the indicator table every `refresh_seconds`.

    The indicator side of a stream-static join is fixed when the query
    starts, so a refresh is a stop and a restart on the same checkpoint:
    state and offsets carry over, only the static side is re-resolved.
    """
    n = 0
    while cycles is None or n < cycles:
        iocs = read_iocs(spark, ioc_table)
        if iocs is None:
            raise RuntimeError(f"no committed indicator table at {ioc_table}")
        keys = prepared_keys(iocs, strict_keys)
        q = start_sink(detection_stream(source(spark), None, exact=exact, keys=keys, salt_buckets=salt_buckets, one_scan=one_scan),
                       checkpoint, fmt, path, options, trigger)
        if trigger and trigger.get("availableNow"):
            q.awaitTermination()
        else:
            q.awaitTermination(timeout=refresh_seconds)
            q.stop()
        if q.exception() is not None:
            raise q.exception()
        n += 1


def document_stream(records: DataFrame, kind: str) -> DataFrame:
    """Raw records -> typed documents for indexing, keyed for idempotent
    upserts: `kind="logs"` decodes sensor JSON (65 typed fields, keyed by the
    full record, text that does not decode kept in `raw_text`),
    `kind="alerts"` decodes alert JSON (missing fields read as null, keyed by
    alert id)."""
    if kind == "logs":
        return raw_log_documents(records)
    if kind == "alerts":
        return alert_documents(decode_alerts(records))
    raise ValueError(f"unknown document kind {kind!r}")


def start_documents(
    records: DataFrame,
    kind: str,
    checkpoint: str,
    path: str,
    trigger: dict | None = None,
    horizon: str = REDELIVERY,
) -> StreamingQuery:
    """Copy a record stream into a document table. A record delivered again
    within `horizon` of event time is dropped by its key; `read_documents`
    folds later ones. Offsets and the file sink's commit log live under
    `checkpoint`, so a restart neither loses nor repeats documents."""
    docs = document_stream(records, kind)
    ensure_table(records.sparkSession, path, docs.schema)
    once = docs.withWatermark("ts" if kind == "logs" else "event_ts", horizon).dropDuplicatesWithinWatermark(["doc_id"])
    return (
        once.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start(path)
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a table, each key once."""
    return spark.read.parquet(path).dropDuplicates(["doc_id"])
