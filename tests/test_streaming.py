"""Streams: same alerts as batch, late data dropped, refresh loop."""

import time

from tidewatch.operators.detect import alerts
from tidewatch.schemas import ALERT_SCHEMA
from tidewatch.session import work_dir
from tidewatch.sources.logs import encode_logs, file_stream
from tidewatch.streaming.detection import detection_stream, run_detection, start_sink
from tests.conftest import at, log_rows
from tests.test_ioc_match import base_iocs


# A record far past the scenarios: it closes their windows.
CLOSING = ('{"@path":"conn","ts":"2024-02-01T00:00:00.000000Z","uid":"closing",'
           '"id.orig_h":"closing","id.resp_h":"closing"}')


def scenario(spark, offset=0.0):
    rows = []
    for i in range(13):  # port scan, High
        rows.append(dict(ts=at(offset + 1 + i * 0.2), uid=f"S{i}", log_path="conn", id_orig_h="10.10.10.5",
                         id_resp_h="203.0.113.9", id_resp_p=1000 + i))
    for i in range(3):  # 3 x 50 MB in one minute: exfiltration, Medium
        rows.append(dict(ts=at(offset + 10 + 2 * i), uid=f"X{i}", log_path="conn", id_orig_h="10.10.10.7",
                         id_resp_h="198.18.0.1", id_resp_p=443, orig_bytes=50_000_000))
    rows.append(dict(ts=at(offset + 20), uid="M1", log_path="http", id_orig_h="10.10.10.2",
                     id_resp_h="9.9.9.9", host="bad.example"))
    return rows


def write_files(spark, folder, batches):
    """One file per batch, written in order (the file source replays by age)."""
    for lines in batches:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)
        time.sleep(0.05)


def lines(spark, rows):
    return [r.value for r in encode_logs(log_rows(spark, rows)).collect()]


def run(spark, folder, iocs):
    base = work_dir(spark, "test-stream")
    out = detection_stream(file_stream(spark, folder, max_files=1), iocs)
    q = start_sink(out, f"{base}/ck", "parquet", f"{base}/out", trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{base}/out")


def key(df):
    return sorted((r.alert_type, r.alert_id, r.severity, r.log_uid, r.event_ts) for r in df.collect())


def test_stream_equals_batch_over_several_triggers(spark):
    rows = scenario(spark) + scenario(spark, offset=130)
    folder = work_dir(spark, "test-feed")
    half = len(rows) // 2
    write_files(spark, folder, [lines(spark, rows[:half]), lines(spark, rows[half:]), [CLOSING]])
    streamed = run(spark, folder, base_iocs(spark))
    batch = alerts(log_rows(spark, rows), base_iocs(spark))
    assert key(streamed) == key(batch)
    assert {r.alert_type for r in streamed.collect()} == {"IOC Match", "Port Scanning", "Data Exfiltration"}


def test_rows_far_below_watermark_are_dropped(spark):
    on_time = scenario(spark, offset=0)
    late = scenario(spark, offset=0.5)  # same windows, delivered after time moved on
    late = [dict(r, uid="L" + r["uid"], id_orig_h="10.10.10.99") for r in late]
    later = [[dict(ts=at(600 + k), uid="T", log_path="conn", id_orig_h="q", id_resp_h="q", id_resp_p=1)]
             for k in range(3)]  # the late-event filter trails eviction by a batch: move time well ahead
    folder = work_dir(spark, "test-feed")
    write_files(spark, folder, [lines(spark, on_time)] + [lines(spark, x) for x in later]
                + [lines(spark, late), [CLOSING]])
    streamed = run(spark, folder, base_iocs(spark))
    assert key(streamed) == key(alerts(log_rows(spark, on_time), base_iocs(spark)))


def test_redelivered_records_within_watermark(spark):
    rows = scenario(spark)
    folder = work_dir(spark, "test-feed")
    write_files(spark, folder, [lines(spark, rows), lines(spark, rows[-1:]), [CLOSING]])
    streamed = {r.alert_type: r for r in run(spark, folder, base_iocs(spark)).collect()}
    assert streamed["IOC Match"].ioc_value == ["http://bad.example/x", "http://bad.example/y"]


def test_run_detection_against_committed_table(spark):
    from tidewatch.plans.ioc_refresh import run_ioc_refresh
    from tidewatch.sinks.outputs import land_raw
    from tests.test_iocs import documents

    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["bad.example"]), raw)
    run_ioc_refresh(spark, raw, table)
    folder, base = work_dir(spark, "test-feed"), work_dir(spark, "test-run")
    write_files(spark, folder, [lines(spark, scenario(spark)), [CLOSING]])
    run_detection(spark, lambda s: file_stream(s, folder, 1), table, f"{base}/ck", path=f"{base}/out",
                  trigger={"availableNow": True}, cycles=1)
    out = spark.read.schema(ALERT_SCHEMA).parquet(f"{base}/out")
    assert sorted(r.alert_type for r in out.collect()) == ["Data Exfiltration", "IOC Match", "Port Scanning"]


def test_document_streams_resume_without_duplicates(spark):
    from tidewatch.sinks.outputs import alert_json
    from tidewatch.streaming.detection import start_documents

    rows = scenario(spark)
    logs_in, alerts_in, base = work_dir(spark, "test-feed"), work_dir(spark, "test-feed"), work_dir(spark, "test-docs")
    write_files(spark, logs_in, [lines(spark, rows[:5])])
    once = {"availableNow": True}
    start_documents(file_stream(spark, logs_in), "logs", f"{base}/ck", f"{base}/out", trigger=once).awaitTermination()
    write_files(spark, logs_in, [lines(spark, rows[5:])])  # restart on the same checkpoint
    start_documents(file_stream(spark, logs_in), "logs", f"{base}/ck", f"{base}/out", trigger=once).awaitTermination()
    docs = spark.read.parquet(f"{base}/out")
    assert docs.count() == len(rows) == docs.select("doc_id").distinct().count()

    a = alerts(log_rows(spark, rows), base_iocs(spark))
    write_files(spark, alerts_in, [[r.value for r in alert_json(a).collect()]])
    q = start_documents(file_stream(spark, alerts_in), "alerts", f"{base}/ack", f"{base}/aout", trigger=once)
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/aout")
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.alert_id for r in a.collect())
    assert got.filter("alert_type = 'Port Scanning'").first().log_uid is None


def test_state_survives_restart(spark):
    """Half of a scan arrives before a restart, half after: the alert needs
    the aggregation state carried over in the checkpoint."""
    from tidewatch.plans.ioc_refresh import run_ioc_refresh
    from tidewatch.sinks.outputs import land_raw
    from tests.test_iocs import documents

    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["unused.example"]), raw)
    run_ioc_refresh(spark, raw, table)
    scan = [dict(ts=at(1 + i), uid=f"S{i}", log_path="conn", id_orig_h="10.10.10.5",
                 id_resp_h="203.0.113.9", id_resp_p=1000 + i) for i in range(10)]
    folder, base = work_dir(spark, "test-feed"), work_dir(spark, "test-run")
    once = {"availableNow": True}
    write_files(spark, folder, [lines(spark, scan[:5])])
    run_detection(spark, lambda s: file_stream(s, folder, 1), table, f"{base}/ck", path=f"{base}/out",
                  trigger=once, cycles=1)
    write_files(spark, folder, [lines(spark, scan[5:]), [CLOSING]])
    run_detection(spark, lambda s: file_stream(s, folder, 1), table, f"{base}/ck", path=f"{base}/out",
                  trigger=once, cycles=1)
    out = spark.read.schema(ALERT_SCHEMA).parquet(f"{base}/out").collect()
    assert [(r.alert_type, r.tags) for r in out] == [("Port Scanning", ["port_scan", "ports_count:10"])]


def test_job_entry_points(spark):
    from tidewatch.jobs import main
    from tidewatch.sinks.outputs import land_raw
    from tests.test_iocs import documents

    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["bad.example"]), raw)
    main(["refresh", "--raw", raw, "--table", table], spark)
    folder, base = work_dir(spark, "test-feed"), work_dir(spark, "test-run")
    write_files(spark, folder, [lines(spark, scenario(spark)), [CLOSING]])
    main(["detect", "--table", table, "--files", folder, "--sink", f"{base}/out",
          "--checkpoint", f"{base}/ck", "--once"], spark)
    out = spark.read.schema(ALERT_SCHEMA).parquet(f"{base}/out")
    assert sorted(r.alert_type for r in out.collect()) == ["Data Exfiltration", "IOC Match", "Port Scanning"]
    main(["scan", "--table", table, "--logs", folder, "--out", f"{base}/batch", "--salt-buckets", "4"], spark)
    batch = spark.read.parquet(f"{base}/batch")
    assert key(batch) == key(out)


def test_restart_picks_up_refreshed_indicators(spark):
    """T8: the static side is resolved when the stream (re)starts."""
    from tidewatch.plans.ioc_refresh import run_ioc_refresh
    from tidewatch.sinks.outputs import land_raw
    from tests.test_iocs import documents

    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["unused.example"]), raw)
    run_ioc_refresh(spark, raw, table)
    early = [dict(ts=at(1), uid="E1", log_path="http", id_orig_h="o", id_resp_h="r", host="bad.example")]
    late = [dict(ts=at(100), uid="L1", log_path="http", id_orig_h="o", id_resp_h="r", host="bad.example")]
    folder, base = work_dir(spark, "test-feed"), work_dir(spark, "test-run")
    once = {"availableNow": True}

    def cycle():
        run_detection(spark, lambda s: file_stream(s, folder, 1), table, f"{base}/ck", path=f"{base}/out",
                      trigger=once, cycles=1)

    write_files(spark, folder, [lines(spark, early)])
    cycle()  # table does not list bad.example yet
    land_raw(documents(spark, "2024-01-02", ["bad.example"]), raw)
    assert run_ioc_refresh(spark, raw, table).changed
    write_files(spark, folder, [lines(spark, late), [CLOSING]])
    cycle()  # restarted on the same checkpoint with the new snapshot
    out = spark.read.schema(ALERT_SCHEMA).parquet(f"{base}/out").collect()
    assert [(r.alert_type, r.log_uid, r.ioc_value) for r in out] == [("IOC Match", "L1", ["bad.example"])]


def test_replay_closes_windows_of_any_year(spark):
    from tidewatch.streaming.feed import replay_alerts
    import datetime as dt

    rows = [dict(r, ts=r["ts"].replace(year=2031)) for r in scenario(spark)]
    logs = log_rows(spark, rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = replay_alerts(spark, logs, base_iocs(spark))
    assert key(got) == key(alerts(logs, base_iocs(spark))) and got.count() == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert min(r.event_ts for r in got.collect()) > dt.datetime(2031, 1, 1)


def test_document_job_drops_redelivered_records(spark):
    from tidewatch.jobs import main
    from tidewatch.streaming.detection import read_documents

    rows = scenario(spark)
    folder, base = work_dir(spark, "test-feed"), work_dir(spark, "test-docs")
    write_files(spark, folder, [lines(spark, rows) * 2, ["{broken"] * 2 + ["other text"]])
    main(["documents", "--kind", "logs", "--files", folder, "--out", f"{base}/out", "--checkpoint", f"{base}/ck", "--once"], spark)
    spark.conf.unset("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    docs = read_documents(spark, f"{base}/out").collect()
    assert len(docs) == len(rows) + 2
    assert sorted(r.raw_text for r in docs if r.raw_text) == ["other text", "{broken"]
