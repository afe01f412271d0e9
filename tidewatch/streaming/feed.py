"""Replay a log table as a stream: sensor JSON files in a landing folder,
read back by the file source exactly as the broker feed would be."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.iocs import prepared_keys
from tidewatch.schemas import ALERT_SCHEMA
from tidewatch.session import parallelism, work_dir
from tidewatch.sinks.claims import delete, names
from tidewatch.sources.logs import encode_logs, file_stream
from tidewatch.streaming.detection import detection_stream, read_documents, start_documents, start_sink
from tidewatch.streaming.documents import document_table, start_upserts
from tidewatch.streaming.metrics import total_drops

#: How far past the last record the closing one lies: the longest window (one
#: minute), twice, and the watermark delay, with room to spare.
CLOSING_GAP = dt.timedelta(minutes=5)


def event_bounds(logs: DataFrame):
    """Earliest and latest event time (lo, hi); None without timed records."""
    return logs.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()


def write_closing(spark: SparkSession, folder: str, last: dt.datetime | None) -> None:
    """A record past the data that moves the watermark beyond every real
    window, so append mode emits all of them (it raises no alert)."""
    if last is None:
        return
    ts = (last + CLOSING_GAP).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    record = json.dumps({"@path": "conn", "ts": ts, "uid": "closing", "id.orig_h": "closing", "id.resp_h": "closing"})
    spark.range(1).select(F.lit(record).alias("value")).write.mode("append").text(folder)


def replay_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own, so that the caller's settings stay as they are.
    State partitions are sized to the cluster's cores; the stream keeps the
    value it started with."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or parallelism(spark)))
    return own


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def replay_alerts(
    spark: SparkSession,
    logs: DataFrame,
    iocs: DataFrame,
    detectors: tuple[str, ...] = ("ioc", "scan", "exfil"),
    exact: bool = True,
    slices: int = 1,
    restart: bool = False,
    state_partitions: int | None = None,
    strict_keys: bool = False,
    one_scan: bool = False,
) -> DataFrame:
    """Run the streaming detector over `logs` (availableNow) and return the
    alerts its file sink committed.

    The feed is written in `slices` event-time slices, in time order, and read
    a slice per micro-batch; a last record then closes the windows. With
    `restart` the stream stops after each slice and starts again on the same
    checkpoint (a scheduled job): windows that straddle a slice are only right
    if state and watermark survive. Records without a time come first.
    """
    base = work_dir(spark, "replay")
    bounds = event_bounds(logs)
    own = replay_session(spark, state_partitions)
    keys = prepared_keys(iocs, strict_keys) if "ioc" in detectors else None

    files = parallelism(spark)

    def run() -> None:
        out = detection_stream(file_stream(own, f"{base}/in/*", None if restart else files), None, detectors, exact, keys=keys, one_scan=one_scan)
        _finish(start_sink(out, f"{base}/checkpoint", "parquet", f"{base}/out", trigger={"availableNow": True}))

    lo, hi = bounds["lo"], bounds["hi"]
    for i in range(slices):
        part = logs
        if slices > 1 and lo is not None:
            edge = lambda k: F.lit(lo) + (F.lit(hi) - F.lit(lo)) * (k / slices)
            inside = (F.col("ts") >= edge(i)) & ((F.col("ts") < edge(i + 1)) if i < slices - 1 else F.lit(True))
            part = logs.filter(inside | F.col("ts").isNull() if i == 0 else inside)
        elif i:
            break
        # As many files a slice as the stream takes in a micro-batch; a slice with
        # fewer records than that may share its micro-batch with the next one.
        feed = encode_logs(part)
        (feed.repartition(files) if slices > 1 and not restart else feed).write.text(f"{base}/in/{i:05d}")
        if restart:
            run()
    write_closing(spark, f"{base}/in/{slices:05d}", hi)
    run()
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{base}/out")


def replay_through(spark: SparkSession, logs: DataFrame, build, state_partitions: int | None = None) -> DataFrame:
    """Replay `logs` as sensor JSON files through `build(records) -> stream`
    into a Parquet file sink; return what the sink committed."""
    base = work_dir(spark, "replay")
    encode_logs(logs).write.text(f"{base}/in")
    out = build(file_stream(replay_session(spark, state_partitions), f"{base}/in"))
    _finish(out.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start(f"{base}/out"))
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def replay_documents(spark: SparkSession, records: DataFrame, kind: str, max_files: int | None = None) -> DataFrame:
    """Run the document copy over `records` (JSON text in `value`)."""
    base = work_dir(spark, "replay")
    records.select("value").write.text(f"{base}/in")
    own = replay_session(spark)
    _finish(start_documents(file_stream(own, f"{base}/in", max_files), kind, f"{base}/checkpoint", f"{base}/out", {"availableNow": True}))
    return read_documents(spark, f"{base}/out")


def replay_upserts(spark: SparkSession, deliveries: list[DataFrame], kind: str, repeat_last: bool = True) -> DataFrame:
    """Run the keyed document copy over deliveries of records (JSON text in
    `value`), one run each on one checkpoint. `repeat_last` then takes the
    stream's note of its last micro-batch away, as a crash between the table's
    commit and the stream's would, and runs once more: Spark repeats the batch."""
    base = work_dir(spark, "replay")
    own = replay_session(spark)
    for i in range(len(deliveries) + repeat_last):
        if i < len(deliveries):
            deliveries[i].select("value").write.text(f"{base}/in/{i:05d}")
        else:
            last = max((n for n, _ in names(spark, f"{base}/checkpoint/commits")), key=int)
            delete(spark, f"{base}/checkpoint/commits/{last}")
        _finish(start_upserts(file_stream(own, f"{base}/in/*"), kind, f"{base}/checkpoint", f"{base}/out", {"availableNow": True}))
    return document_table(spark, kind, f"{base}/out").read()


def replay_drops(spark: SparkSession, deliveries: list[DataFrame], iocs: DataFrame) -> dict[str, int]:
    """Run the one-scan detector over deliveries of records, one run each on one
    checkpoint, and sum what its micro-batches drop."""
    base = work_dir(spark, "replay")
    own = replay_session(spark)
    keys = prepared_keys(iocs)
    reports = []
    for i, records in enumerate(deliveries):
        records.select("value").write.text(f"{base}/in/{i:05d}")
        query = start_sink(detection_stream(file_stream(own, f"{base}/in/*"), None, keys=keys, one_scan=True),
                           f"{base}/checkpoint", "parquet", f"{base}/out", trigger={"availableNow": True})
        _finish(query)
        reports += query.recentProgress
    return dict(total_drops(reports))
