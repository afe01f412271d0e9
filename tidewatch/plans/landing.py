"""Indicator refresh that follows the landing area file by file.

The landing area is read as a file stream whose checkpoint log holds every file
taken, so a file is merged once, whenever it lands and whatever day its folder
names: a pull that arrives days late is found by the next run, and no day is
listed by date or read again. Each micro-batch is one change of a bucketed
indicator table (sinks/keyed.py): its indicators are folded per id, the buckets
of those ids are read, and only buckets in which something changes are written
again. A micro-batch that is replayed after a crash commits nothing.

The table's notes hold the marker (latest landing day merged) and the number of
buckets, which is fixed when the table is made.
"""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.sizing import broadcast_if_small
from tidewatch.operators.iocs import batch_per_id, clean_iocs, explode_raw, merge_iocs
from tidewatch.schemas import CLEAN_IOC_SCHEMA
from tidewatch.session import checkpoint_root
from tidewatch.sinks.claims import CommitConflict
from tidewatch.sinks.keyed import Head, KeyedTable, bucket_of
from tidewatch.sources.iocs import folder_date, raw_stream

BUCKETS = 16
TRIES = 5


@dataclass
class Followed:
    """What a run did: micro-batches merged, documents and indicators read,
    indicators dropped for want of an `ioc`, buckets read and written."""

    batches: int = 0
    documents: int = 0
    indicators: int = 0
    without_ioc: int = 0
    buckets_read: list[int] = field(default_factory=list)
    buckets_written: list[int] = field(default_factory=list)


def ioc_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    """The bucketed indicator table at `path`; an existing one keeps its buckets."""
    table = KeyedTable(spark, path, CLEAN_IOC_SCHEMA, "id", F.lit(None))
    table.part = bucket_of("id", int(table.head().notes.get("buckets", buckets)))
    table.buckets = int(table.head().notes.get("buckets", buckets))
    return table


def changed_rows(current: DataFrame, folded: DataFrame) -> DataFrame:
    """Rows of a folded increment whose id the table lacks or saw earlier. The
    table's rows are met by the increment's ids where those measure small, so
    that only the ids they share go on."""
    ids, _ = broadcast_if_small(folded.select("id"))
    held = current.select("id", F.col("last_seen").alias("held"), F.lit(True).alias("known")).join(ids, "id", "left_semi")
    later = F.col("last_seen").isNotNull() & (F.col("held").isNull() | (F.col("last_seen") > F.col("held")))
    return folded.join(held, "id", "left").where(F.col("known").isNull() | later).select(*folded.columns)


def merge_landed(table: KeyedTable, documents: DataFrame, txn: tuple[str, int] | None = None, shift_hours: int = 3, report: Followed | None = None) -> Head:
    """Merge raw documents (with `folder_date`) into the table in one commit."""
    spark = documents.sparkSession
    seen = Observation("landed")
    batch = documents.observe(seen, F.max("folder_date").alias("marker"), F.count(F.lit(1)).alias("documents"))
    entries = Observation("indicators")
    flat = explode_raw(batch).observe(entries, F.count(F.lit(1)).alias("all"), F.count_if(F.col("ioc").isNull()).alias("without"))
    checkpoint_root(spark)
    folded = batch_per_id(clean_iocs(flat, shift_hours)).checkpoint(eager=True)  # the files are read once
    parts = lambda rows: sorted(r[0] for r in rows.select(table.part.alias("p")).distinct().collect())  # noqa: E731  at most `buckets`
    touched = parts(folded)
    report = report or Followed()
    for _ in range(TRIES):
        head = table.head()
        if txn and head.writers.get(txn[0], -1) >= txn[1]:
            return head
        marker = max((str(d) for d in (head.notes.get("marker"), seen.get["marker"]) if d), default=None)
        notes = {"buckets": str(table.buckets), **({"marker": marker} if marker else {})}
        delta = changed_rows(table.read(touched, head), folded).checkpoint(eager=True)
        changed = parts(delta)
        try:
            if changed:
                old = table.read(changed, head) if any(p in head.parts for p in changed) else None
                new = table.replace(changed, merge_iocs(old, delta, unique=True), head, txn, notes)
            else:
                new = table.note(head, txn, notes)
        except CommitConflict:
            continue
        report.batches += 1
        report.documents += seen.get["documents"]
        report.indicators += entries.get["all"]
        report.without_ioc += entries.get["without"]
        report.buckets_read.append(len(touched))
        report.buckets_written.append(len(changed))
        return new
    raise CommitConflict(f"{table.path}: lost {TRIES} versions to other writers")


def follow_landing(spark: SparkSession, raw_base: str, path: str, checkpoint: str | None = None, buckets: int = BUCKETS,
                   max_files: int | None = None, shift_hours: int = 3, trigger: dict | None = None) -> Followed:
    """Merge every file of the landing area that the checkpoint does not hold
    yet, `max_files` a micro-batch, then stop (or go on, with a `trigger`)."""
    table, report = ioc_table(spark, path, buckets), Followed()
    writer: dict[str, str] = {}
    started = threading.Event()

    def merge(documents: DataFrame, batch: int) -> None:
        started.wait()
        merge_landed(table, documents.withColumn("folder_date", folder_date()), (writer["id"], batch), shift_hours, report)

    query = (raw_stream(spark, raw_base, max_files).writeStream.foreachBatch(merge)
             .option("checkpointLocation", checkpoint or f"{path.rstrip('/')}/progress")
             .trigger(**(trigger or {"availableNow": True})).start())
    writer["id"] = str(query.id)  # the same for every run on this checkpoint
    started.set()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return report


def marker_of(table: KeyedTable) -> dt.date | None:
    """Latest landing day merged into the table."""
    marker = table.head().notes.get("marker")
    return dt.date.fromisoformat(marker) if marker else None
