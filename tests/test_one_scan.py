"""One read and one aggregation for all detectors; what a stream drops."""

import pytest

from tests.conftest import log_rows
from tests.test_ioc_match import base_iocs
from tests.test_streaming import CLOSING, key, lines, scenario, write_files
from tidewatch.operators.detect import DEFAULT, Thresholds, alerts, alerts_one_scan
from tidewatch.schemas import ALERT_SCHEMA
from tidewatch.session import work_dir
from tidewatch.sources import fixtures as fx
from tidewatch.sources.logs import file_stream
from tidewatch.streaming.detection import detection_stream, start_sink
from tidewatch.streaming.metrics import DropReport, drops_of, total_drops

SF = "/root/testdata/sf0.001"


def full(df):
    return sorted(tuple(r[c] for c in df.columns if c != "alert_ts") for r in df.collect())


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("limit", [None, 0])
def test_equals_the_three_detectors(spark, limit):
    logs, iocs = fx.net(spark, SF), fx.iocs(spark, SF)
    want = [tuple(r[c] for c in ALERT_SCHEMA.fieldNames() if c != "alert_ts") for r in alerts(logs, iocs).collect()]
    got = [tuple(r[c] for c in ALERT_SCHEMA.fieldNames() if c != "alert_ts") for r in alerts_one_scan(logs, iocs, broadcast_limit=limit, salt_buckets=4).collect()]
    assert ordered(got) == ordered(want) and len(want) > 100


def test_strict_keys_and_nulls(spark):
    untidy, iocs = fx.net_untidy(spark, SF), fx.iocs(spark, SF)
    assert key(alerts_one_scan(untidy, iocs, strict_keys=True)) == key(alerts(untidy, iocs, strict_keys=True))
    rows = scenario(spark) + [dict(uid=None, ts=None), dict(uid=None, ts=scenario(spark)[0]["ts"], host="bad.example", id_orig_h=None)]
    logs = log_rows(spark, rows)
    assert key(alerts_one_scan(logs, base_iocs(spark))) == key(alerts(logs, base_iocs(spark)))
    assert alerts_one_scan(log_rows(spark, []), base_iocs(spark)).count() == 0


def test_windows_must_divide(spark):
    with pytest.raises(ValueError, match="divide"):
        alerts_one_scan(log_rows(spark, []), base_iocs(spark), t=Thresholds(ioc_window="7 seconds"))
    assert DEFAULT.ioc_window == "5 seconds"


def test_one_log_scan_and_one_shuffle_of_hits(spark):
    logs = fx.net(spark, SF, hosts=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = alerts_one_scan(logs, fx.iocs(spark, SF))._jdf.queryExecution().executedPlan().toString()
        both = alerts(logs, fx.iocs(spark, SF))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("events.parquet") == 1 and both.count("events.parquet") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def stream(spark, folder, **options):
    base = work_dir(spark, "test-one-scan")
    out = detection_stream(file_stream(spark, folder, max_files=1), base_iocs(spark), one_scan=True)
    q = start_sink(out, f"{base}/ck", "parquet", f"{base}/out", trigger={"availableNow": True}, **options)
    q.awaitTermination()
    assert q.exception() is None
    return q, spark.read.schema(ALERT_SCHEMA).parquet(f"{base}/out")


def test_each_record_is_read_once_a_trigger(spark):
    rows = scenario(spark) + scenario(spark, offset=130)
    folder = work_dir(spark, "test-feed")
    half = len(rows) // 2
    write_files(spark, folder, [lines(spark, rows[:half]), lines(spark, rows[half:]), [CLOSING]])
    q, out = stream(spark, folder)
    assert sum(p.numInputRows for p in q.recentProgress) == len(rows) + 1
    assert max(len(p.stateOperators) for p in q.recentProgress) == 1
    assert key(out) == key(alerts(log_rows(spark, rows), base_iocs(spark)))


def test_drops_are_counted_by_cause(spark):
    rows = scenario(spark)
    late = [dict(r, id_orig_h="10.10.10.99") for r in rows[:4]]
    beyond = ['{"@path":"conn","ts":"2024-02-0%dT00:00:00.000000Z","uid":"t","id.orig_h":"t","id.resp_h":"t"}' % d for d in (1, 2)]
    folder = work_dir(spark, "test-feed")
    write_files(spark, folder, [lines(spark, rows) + ["{broken", "junk"], beyond[:1], beyond[1:], lines(spark, late) + ['{"uid":"no time"}']])
    said = []
    report = DropReport(said.append)
    spark.streams.addListener(report)
    try:
        q, _ = stream(spark, folder, name="drops")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(report)
    want = {"records": len(rows) + 5 + len(late), "undecodable": 2, "untimed": 1, "late_groups": 1}
    assert dict(total_drops(q.recentProgress)) == want
    assert sum((drops_of(p) for p in q.recentProgress), start=type(report.total)())["records"] == want["records"]
    assert report.total["undecodable"] == 2 and any('"undecodable": 2' in s for s in said)
