"""Document tables kept free of repeats for any delay of a redelivery.

Each micro-batch of a record stream is one change of a keyed table
(sinks/keyed.py). A document's key fixes its event time, so its hour is its
part: a record that comes back after a second or after a year meets the keys of
that hour only, and is left out. No state store and no horizon is involved, and
reading the table needs no fold. The micro-batch id is the transaction number:
a batch that Spark replays after a crash is recognised by it.

Documents without a time are one part of their own. An alert that comes again
with another processing time is the same document; the stored one stays, and of
several in one batch the earliest is stored.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.schemas import ALERT_SCHEMA, WIDE_SCHEMA
from tidewatch.sinks.keyed import KeyedTable, hour_of
from tidewatch.streaming.detection import TRIGGER, document_stream

LOG_DOCUMENTS = T.StructType([T.StructField("doc_id", T.StringType()), *WIDE_SCHEMA.fields, T.StructField("raw_text", T.StringType())])
ALERT_DOCUMENTS = T.StructType([T.StructField("doc_id", T.StringType()), *ALERT_SCHEMA.fields])


def document_table(spark: SparkSession, kind: str, path: str, hours: int = 1) -> KeyedTable:
    """The table of `kind` ("logs" or "alerts") at `path`, empty if it is new;
    `hours`: the event time of a part, a setting of the table."""
    if kind == "logs":
        return KeyedTable(spark, path, LOG_DOCUMENTS, "doc_id", hour_of("ts", hours))
    if kind == "alerts":
        return KeyedTable(spark, path, ALERT_DOCUMENTS, "doc_id", hour_of("event_ts", hours), order=["alert_ts", "log_uid", "severity"])
    raise ValueError(f"unknown document kind {kind!r}")


def start_upserts(records: DataFrame, kind: str, checkpoint: str, path: str, trigger: dict | None = None, hours: int = 1) -> StreamingQuery:
    """Copy a record stream into a document table, each key once."""
    table = document_table(records.sparkSession, kind, path, hours)
    writer: dict[str, str] = {}
    started = threading.Event()

    def store(batch: DataFrame, number: int) -> None:
        started.wait()
        table.insert_new(document_stream(batch, kind), (writer["id"], number))

    query = (records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"processingTime": TRIGGER})).start())
    writer["id"] = str(query.id)  # the same for every run on this checkpoint
    started.set()
    return query
