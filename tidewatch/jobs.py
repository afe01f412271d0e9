"""Command-line entry points of the production jobs (spark-submit).

    spark-submit --py-files tidewatch.zip tidewatch/jobs.py refresh --raw s3a://b/raw --table s3a://b/iocs
    spark-submit --py-files tidewatch.zip tidewatch/jobs.py detect --table s3a://b/iocs \\
        --kafka-servers host:9092 --topic logs --alerts-topic alerts
    python -m tidewatch.jobs detect --table T --files IN --sink OUT --once
    python -m tidewatch.jobs scan --table T --logs ARCHIVE --out OUT
    python -m tidewatch.jobs documents --kind logs --files IN --out OUT --once
    python -m tidewatch.jobs documents --upsert --kind logs --files IN --out OUT --once
    python -m tidewatch.jobs follow --raw RAW --table IOCS
    python -m tidewatch.jobs land --pulls PULLED --raw RAW --day 2024-01-31

Checkpoints default to a per-query folder under `spark.checkpoint.dir`.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from tidewatch.operators.detect import SALT_BUCKETS, alerts
from tidewatch.plans.ioc_refresh import run_ioc_refresh
from tidewatch.plans.landing import BUCKETS, follow_landing
from tidewatch.session import checkpoint_root
from tidewatch.sinks.outputs import land_pulls
from tidewatch.sources.iocs import read_iocs
from tidewatch.sources.logs import DETECTOR_FIELDS, file_stream, kafka_stream, read_logs
from tidewatch.streaming.detection import REDELIVERY, REFRESH_SECONDS, TRIGGER, run_detection, start_documents
from tidewatch.streaming.documents import start_upserts
from tidewatch.streaming.metrics import DropReport

#: State stores commit a file per partition and trigger: far fewer than a
#: batch shuffle has.
STATE_PARTITIONS = 200


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidewatch.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    r = sub.add_parser("refresh", help="merge newly landed raw indicator days into the table")
    r.add_argument("--raw", required=True)
    r.add_argument("--table", required=True)
    r.add_argument("--shift-hours", type=int, default=3)
    r.add_argument("--skip-marker-day", action="store_true", help="do not look for files that landed late in the last merged day")
    r.add_argument("--keep-snapshots", type=int, default=None, help="delete snapshots older than the latest N")
    f = sub.add_parser("follow", help="merge landed raw files that no run has merged yet, whatever day they belong to")
    f.add_argument("--raw", required=True)
    f.add_argument("--table", required=True)
    f.add_argument("--shift-hours", type=int, default=3)
    f.add_argument("--buckets", type=int, default=BUCKETS, help="hash buckets of a new table")
    f.add_argument("--max-files", type=int, default=None, help="files of a micro-batch")
    f.add_argument("--checkpoint", help="progress folder (default: in the table's folder)")
    w = sub.add_parser("land", help="land pulled payload files (one JSON document each) under a day of the raw area")
    w.add_argument("--pulls", required=True)
    w.add_argument("--raw", required=True)
    w.add_argument("--day", required=True, type=dt.date.fromisoformat)
    c = sub.add_parser("documents", help="copy a log or alert stream into a document table")
    c.add_argument("--kind", choices=("logs", "alerts"), required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--upsert", action="store_true", help="store each key once for any delay (no horizon, no state)")
    c.add_argument("--horizon", default=REDELIVERY, help="event time within which redelivered records are dropped")
    b = sub.add_parser("scan", help="run the detectors over a landed log archive (batch)")
    b.add_argument("--table", required=True, help="clean indicator table")
    b.add_argument("--logs", required=True, help="folder of JSON-lines log files")
    b.add_argument("--out", required=True, help="alert table folder (written once)")
    d = sub.add_parser("detect", help="run the detection stream")
    d.add_argument("--table", required=True, help="clean indicator table")
    d.add_argument("--alerts-topic", help="alert topic (Kafka sink)")
    d.add_argument("--sink", help="alert table folder (file sink)")
    d.add_argument("--one-scan", action="store_true", help="one read and one state store for all detectors; IOC alerts up to a minute later")
    d.add_argument("--report-drops", action="store_true", help="print what each micro-batch drops (needs --one-scan)")
    d.add_argument("--refresh-seconds", type=float, default=REFRESH_SECONDS)
    for x in (b, d):
        x.add_argument("--approx", action="store_true", help="approximate distinct port counts")
        x.add_argument("--strict-keys", action="store_true", help="match without case, port and IPv6 brackets")
        x.add_argument("--salt-buckets", type=int, default=SALT_BUCKETS, help="ways a match value is split when the indicators are not broadcast")
    for x in (c, d):
        x.add_argument("--kafka-servers")
        x.add_argument("--topic", help="record topic")
        x.add_argument("--files", help="folder of JSON-lines files (file source)")
        x.add_argument("--checkpoint")
        x.add_argument("--max-offsets", type=int, default=None, help="cap of a trigger (default: all that has arrived)")
        x.add_argument("--max-files", type=int, default=1000, help="files of a micro-batch, oldest first")
        x.add_argument("--allow-data-loss", action="store_true", help="skip gaps left by topic retention")
        x.add_argument("--trigger", default=TRIGGER)
        x.add_argument("--state-partitions", type=int, default=STATE_PARTITIONS, help="partitions of each state store, fixed at the first start")
        x.add_argument("--once", action="store_true", help="process what is available, then stop")
    return p.parse_args(argv)


def _source(args: argparse.Namespace):
    if args.kafka_servers:
        return lambda s: kafka_stream(s, args.kafka_servers, args.topic, args.max_offsets, fail_on_data_loss=not args.allow_data_loss)
    return lambda s: file_stream(s, args.files, args.max_files)


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    spark = spark or SparkSession.builder.appName(f"tidewatch-{args.job}").getOrCreate()
    if args.job == "refresh":
        res = run_ioc_refresh(spark, args.raw, args.table, args.shift_hours, not args.skip_marker_day, args.keep_snapshots)
        print(f"refresh: changed={res.changed} version={res.version} marker={res.marker}")
        return
    if args.job == "follow":
        done = follow_landing(spark, args.raw, args.table, args.checkpoint, args.buckets, args.max_files, args.shift_hours)
        print(f"follow: documents={done.documents} indicators={done.indicators} without_ioc={done.without_ioc} buckets_written={sum(done.buckets_written)}")
        return
    if args.job == "land":
        land_pulls(spark, args.pulls, args.raw, args.day)
        return
    if args.job == "scan":
        iocs = read_iocs(spark, args.table)
        if iocs is None:
            raise SystemExit(f"no committed indicator table at {args.table}")
        logs = read_logs(spark, args.logs, DETECTOR_FIELDS)
        found = alerts(logs, iocs, exact=not args.approx, salt_buckets=args.salt_buckets, strict_keys=args.strict_keys)
        found.write.mode("errorifexists").parquet(args.out)
        return
    spark.conf.set("spark.sql.shuffle.partitions", str(args.state_partitions))
    checkpoint = args.checkpoint or f"{checkpoint_root(spark).rstrip('/')}/tidewatch/{args.job}" + (f"-{args.kind}" if args.job == "documents" else "")
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    source = _source(args)
    if args.job == "documents":
        if args.upsert:
            q = start_upserts(source(spark), args.kind, checkpoint, args.out, trigger)
        else:
            q = start_documents(source(spark), args.kind, checkpoint, args.out, trigger, args.horizon)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        return
    if args.kafka_servers:
        fmt, path, options = "kafka", None, {"kafka.bootstrap.servers": args.kafka_servers, "topic": args.alerts_topic}
    else:
        fmt, path, options = "parquet", args.sink, None
    if args.report_drops:
        spark.streams.addListener(DropReport())
    run_detection(spark, source, args.table, checkpoint, fmt, path, options, trigger,
                  args.refresh_seconds, cycles=1 if args.once else None, exact=not args.approx,
                  salt_buckets=args.salt_buckets, strict_keys=args.strict_keys, one_scan=args.one_scan)


if __name__ == "__main__":
    main()
