"""Keyed tables: atomic commits, parts carried over by name, repeats left out."""

import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, log_rows
from tidewatch.session import work_dir
from tidewatch.sinks.claims import CommitConflict, claim, names, read_text
from tidewatch.sinks.keyed import KeyedTable, bucket_of, hour_of

SCHEMA = "k string, ts timestamp, v int"


def rows(spark, *items):
    return spark.createDataFrame([(k, at(s) if s is not None else None, v) for k, s, v in items], SCHEMA)


def table(spark, path=None, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return KeyedTable(spark, path or work_dir(spark, "test-keyed"), schema, "k", hour_of("ts"), **options)


def held(t):
    return sorted((r.k, r.v) for r in t.read().collect())


def test_a_name_is_claimed_once_and_whole(spark):
    folder = work_dir(spark, "test-claim")
    results, start = [], threading.Barrier(8)

    def run(i):
        start.wait()
        results.append((claim(spark, f"{folder}/0.json", json.dumps({"by": i, "pad": "x" * 10000})), i))

    threads = [threading.Thread(target=run, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    (winner,) = [i for ok, i in results if ok]
    assert json.loads(read_text(spark, f"{folder}/0.json"))["by"] == winner
    assert [n for n, _ in names(spark, folder)] == ["0.json"]


def test_new_keys_are_stored_and_known_ones_stay(spark):
    t = table(spark)
    assert held(t) == [] and t.head().version == -1
    t.insert_new(rows(spark, ("a", 1, 1), ("b", 2, 1), ("z", None, 1), (None, 1, 1)))
    t.insert_new(rows(spark, ("a", 1, 2), ("c", 3, 2), ("z", None, 2)))
    assert held(t) == [("a", 1), ("b", 1), ("c", 2), ("z", 1)]
    before = t.head()
    t.insert_new(rows(spark, ("a", 1, 3)))  # nothing new: no run stays behind
    assert t.head().parts == before.parts
    assert {n for n, _ in names(spark, f"{t.path}/data")} == {run for runs in before.parts.values() for run in runs}


def test_a_repeated_transaction_changes_nothing(spark):
    t = table(spark)
    t.insert_new(rows(spark, ("a", 1, 1)), ("w", 4))
    version = t.head().version
    t.insert_new(rows(spark, ("b", 1, 1)), ("w", 4))
    t.insert_new(rows(spark, ("b", 1, 1)), ("w", 3))
    assert t.head().version == version and held(t) == [("a", 1)]
    t.insert_new(rows(spark, ("b", 1, 1)), ("other", 0))
    t.insert_new(rows(spark), ("w", 5))  # an empty batch is noted
    assert held(t) == [("a", 1), ("b", 1)] and t.head().writers == {"w": 5, "other": 0}


def test_only_touched_parts_are_read_and_written(spark):
    t = table(spark)
    t.insert_new(rows(spark, *((f"k{h}", 3600 * h, 0) for h in range(5))))
    first = t.head()
    opened = []
    read = t.read
    t.read = lambda parts=None, head=None: opened.append(parts) or read(parts, head)
    t.insert_new(rows(spark, ("k3", 3 * 3600, 9), ("new", 3 * 3600 + 1, 9)))
    changed = {p for p, runs in t.head().parts.items() if runs != first.parts.get(p)}
    assert len(changed) == 1 and opened == [sorted(changed)]


def test_smallest_row_by_order_counts_in_one_batch(spark):
    t = table(spark, order=["v"])
    t.insert_new(rows(spark, ("a", 1, 5), ("a", 1, 2), ("a", 1, 9)))
    assert held(t) == [("a", 2)]


def test_two_writers_lose_no_rows(spark):
    path = work_dir(spark, "test-keyed")
    start = threading.Barrier(4)
    errors = []

    def run(i):
        t = table(spark, path)
        start.wait()
        try:
            for n in range(3):
                t.insert_new(rows(spark, (f"{i}-{n}", n, i), ("shared", 1, i)), (f"w{i}", n))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    keys = [k for k, _ in held(table(spark, path))]
    assert sorted(keys) == sorted([f"{i}-{n}" for i in range(4) for n in range(3)] + ["shared"])


def test_replace_from_an_old_state_fails(spark):
    t = table(spark)
    t.insert_new(rows(spark, ("a", 1, 1)))
    seen = t.head()
    t.insert_new(rows(spark, ("b", 1, 1)))
    with pytest.raises(CommitConflict):
        t.replace(list(seen.parts), rows(spark, ("a", 1, 7)), seen)
    assert held(t) == [("a", 1), ("b", 1)]


def test_runs_of_a_part_are_folded_and_old_files_go(spark):
    t = table(spark, max_runs=3)
    for i in range(6):
        t.insert_new(rows(spark, (f"k{i}", 1, i)))
    assert max(map(len, t.head().parts.values())) <= 3 and len(held(t)) == 6
    assert t.vacuum(keep=1, older_than=86400) == 0  # young files may belong to a change in progress
    t.vacuum(keep=1, older_than=-1)
    live = {run for runs in t.head().parts.values() for run in runs}
    assert {n for n, _ in names(spark, f"{t.path}/data")} == live and len(t.versions()) == 1
    assert len(held(t)) == 6


def test_parts_do_not_depend_on_the_session_zone(spark):
    df = rows(spark, ("a", 7200, 1)).select(hour_of("ts").alias("p"), bucket_of("k", 4).alias("b"))
    one = df.first()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert df.first() == one and one.p == str((1704067200 + 7200) // 3600)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# ------------------------------------------------------------ the two users


def test_documents_of_any_delay_are_stored_once(spark):
    from tests.test_streaming import lines, scenario
    from tidewatch.streaming.feed import replay_upserts

    text = lambda some: spark.createDataFrame([(x,) for x in some], "value string")
    old, new = lines(spark, scenario(spark)), lines(spark, scenario(spark, offset=90000.0))
    broken = ["{broken", "{broken", "other text"]
    got = replay_upserts(spark, [text(old + broken), text(new), text(old + new + broken)], "logs").collect()
    assert len(got) == len({r.doc_id for r in got}) == len(set(old)) + len(set(new)) + 2
    assert sorted(r.raw_text for r in got if r.raw_text) == ["other text", "{broken"]


def test_first_stored_alert_stays(spark):
    from tests.test_ioc_match import base_iocs
    from tests.test_streaming import scenario
    from tidewatch.operators.detect import alerts
    from tidewatch.sinks.outputs import alert_json
    from tidewatch.streaming.feed import replay_upserts

    logs = log_rows(spark, scenario(spark))
    days = [alert_json(alerts(logs, base_iocs(spark), alert_ts=F.lit(f"2024-03-0{d}").cast("timestamp"))) for d in (2, 1)]
    got = replay_upserts(spark, days, "alerts").collect()
    assert len(got) == 3 and {r.alert_ts for r in got} == {dt.datetime(2024, 3, 2)}


def test_document_job_upserts(spark):
    from tests.test_streaming import lines, scenario, write_files
    from tidewatch.jobs import main
    from tidewatch.streaming.documents import document_table

    some = lines(spark, scenario(spark))
    folder, base = work_dir(spark, "test-feed"), work_dir(spark, "test-docs")
    for _ in range(2):
        write_files(spark, folder, [some])
        main(["documents", "--upsert", "--kind", "logs", "--files", folder, "--out", f"{base}/out", "--checkpoint", f"{base}/ck", "--once"], spark)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    t = document_table(spark, "logs", f"{base}/out")
    assert t.read().count() == len(set(some))


def test_late_files_are_merged_once(spark):
    from tests.test_iocs import documents
    from tidewatch.plans.landing import follow_landing, ioc_table, marker_of
    from tidewatch.sinks.outputs import land_raw
    from tidewatch.sources.iocs import read_iocs

    raw, path = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-03", ["a", "b"]), raw)
    assert follow_landing(spark, raw, path).documents == 1
    land_raw(documents(spark, "2024-01-01", ["late"]), raw)  # two days before the marker
    report = follow_landing(spark, raw, path)
    assert report.documents == 1 and report.buckets_written == [1]
    assert sorted(r.ioc for r in read_iocs(spark, path).collect()) == ["a", "b", "late"]
    t = ioc_table(spark, path)
    assert marker_of(t) == dt.date(2024, 1, 3) and t.buckets == 16
    version = t.head().version
    assert follow_landing(spark, raw, path).batches == 0 and t.head().version == version
    land_raw(documents(spark, "2024-01-01", ["late"]), raw)  # the same pull again: noted, nothing rewritten
    assert follow_landing(spark, raw, path).buckets_written == [0]


def test_only_buckets_with_changes_are_rewritten(spark):
    from tests.test_iocs import documents
    from tidewatch.plans.landing import follow_landing, ioc_table
    from tidewatch.sinks.outputs import land_raw

    raw, path = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", [f"host{i}.example" for i in range(200)]), raw)
    follow_landing(spark, raw, path, buckets=32)
    before = ioc_table(spark, path).head()
    land_raw(documents(spark, "2024-01-02", ["host7.example", "fresh.example"]), raw)
    report = follow_landing(spark, raw, path)
    after = ioc_table(spark, path).head()
    assert len(before.parts) > 20 and sum(report.buckets_read) <= 2
    assert sum(after.parts[p] != before.parts.get(p) for p in after.parts) == report.buckets_written[0] <= 2
    files = ioc_table(spark, path).read([p for p in after.parts if after.parts[p] != before.parts.get(p)]).inputFiles()
    assert all("part=" in f and any(after.parts[f.split("part=")[1].split("/")[0]][0] in f for _ in "x") for f in files)


def test_a_repeated_batch_of_files_commits_nothing(spark):
    from tests.test_iocs import documents
    from tidewatch.plans.landing import ioc_table, merge_landed

    t = ioc_table(spark, work_dir(spark, "test-table"))
    docs = documents(spark, "2024-01-01", ["a"]).withColumn("folder_date", F.lit(dt.date(2024, 1, 1)))
    merge_landed(t, docs, ("w", 0))
    version = t.head().version
    merge_landed(t, docs, ("w", 0))
    assert t.head().version == version and t.read().count() == 1


def test_interleaved_refreshes_commit_once(spark, monkeypatch):
    """Both runs read version 0 and write their snapshots before either commits."""
    from tests.test_iocs import documents
    from tidewatch.plans import ioc_refresh as job
    from tidewatch.sinks.outputs import land_raw
    from tidewatch.sources.iocs import read_iocs

    raw, path = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["a"]), raw)
    job.run_ioc_refresh(spark, raw, path)
    land_raw(documents(spark, "2024-01-02", ["b"]), raw)
    meet, real, out = threading.Barrier(2), job.claim, []

    def together(*a):
        meet.wait(60)
        return real(*a)

    monkeypatch.setattr(job, "claim", together)

    def run():
        try:
            out.append(job.run_ioc_refresh(spark, raw, path).version)
        except CommitConflict:
            out.append("lost")

    threads = [threading.Thread(target=run) for _ in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(map(str, out)) == ["1", "lost"]
    assert sorted(r.ioc for r in read_iocs(spark, path).collect()) == ["a", "b"]
