"""Indicator cleaning, merge properties and the incremental refresh job."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from tidewatch.operators.iocs import clean_iocs, explode_raw, merge_iocs, new_iocs, refresh_last_seen
from tidewatch.plans.ioc_refresh import run_ioc_refresh
from tidewatch.schemas import RAW_IOC_DOCUMENT
from tidewatch.session import work_dir
from tidewatch.sinks.outputs import land_raw
from tidewatch.sources.iocs import read_iocs, read_marker

ENTRY_DDL = ("id string, ioc string, ioc_type string, reporter string, first_seen string, last_seen string, "
             "reference string, confidence_level string, is_compromised boolean")


def entries(spark, rows):
    return spark.createDataFrame(rows, ENTRY_DDL)


def e(ioc, first="2024-01-01 10:00:00 UTC", last=None, reporter="r1", reference="http://ref", conf="50"):
    return ("src-id", ioc, "domain", reporter, first, last, reference, conf, False)


def test_clean_rules(spark):
    rows = [
        e("a.example", reporter="anonymous", reference="", conf="junk"),
        e("b.example", last="2024-01-02 11:00:00 UTC"),
        e(None),
        e("c.example", first="garbage"),
        e("d.example", conf="50.7"),
        e("e.example", conf="1e12"),
    ]
    out = {r.ioc: r for r in clean_iocs(entries(spark, rows)).collect()}
    assert set(out) == {"a.example", "b.example", "c.example", "d.example", "e.example"}  # null ioc dropped
    assert out["d.example"].confidence_level == 50 and out["e.example"].confidence_level is None
    a, b, c = out["a.example"], out["b.example"], out["c.example"]
    assert a.reporter is None and a.reference is None and a.confidence_level is None
    assert a.id == hashlib.sha256(b"a.example").hexdigest()
    assert a.first_seen == dt.datetime(2024, 1, 1, 13, 0) and a.last_seen == a.first_seen
    assert b.reporter == "r1" and b.reference == "http://ref" and b.confidence_level == 50
    assert b.last_seen == dt.datetime(2024, 1, 2, 14, 0)
    assert c.first_seen is None


def cleaned(spark, rows):
    return clean_iocs(entries(spark, rows))


def test_merge_one_row_per_id_and_idempotent(spark):
    cur = merge_iocs(None, cleaned(spark, [e("a"), e("b"), e("a", first="2023-12-31 10:00:00")]))
    assert cur.count() == 2
    a = [r for r in cur.collect() if r.ioc == "a"][0]
    assert a.first_seen == dt.datetime(2023, 12, 31, 13, 0)  # earliest batch row wins
    batch = cleaned(spark, [e("b", last="2024-01-05 00:00:00"), e("c"), e("c", last="2024-01-03 00:00:00")])
    once = merge_iocs(cur, batch)
    twice = merge_iocs(once, batch)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(once) == key(twice)
    assert once.count() == 3
    rows = {r.ioc: r for r in once.collect()}
    assert rows["b"].last_seen == dt.datetime(2024, 1, 5, 3, 0)
    assert rows["c"].last_seen == dt.datetime(2024, 1, 3, 3, 0)


def test_last_seen_never_decreases(spark):
    cur = merge_iocs(None, cleaned(spark, [e("a", last="2024-01-09 00:00:00")]))
    out = merge_iocs(cur, cleaned(spark, [e("a", last="2024-01-02 00:00:00")])).first()
    assert out.last_seen == dt.datetime(2024, 1, 9, 3, 0)


def test_merge_equals_new_union_refreshed(spark):
    cur = merge_iocs(None, cleaned(spark, [e("a"), e("b")]))
    batch = cleaned(spark, [e("b", last="2024-01-04 00:00:00"), e("c"), e("c")])
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(merge_iocs(cur, batch)) == key(new_iocs(cur, batch).unionByName(refresh_last_seen(cur, batch)))


def documents(spark, day, iocs_):
    data = [{"id": str(i), "ioc": x, "ioc_type": "domain", "reporter": "r", "first_seen": f"{day} 10:00:00 UTC",
             "last_seen": f"{day} 12:00:00 UTC", "reference": "", "confidence_level": "5"} for i, x in enumerate(iocs_)]
    d = dt.date.fromisoformat(day)
    df = spark.createDataFrame([("ok", data)], RAW_IOC_DOCUMENT)
    return df.select("*", F.lit(d.year).alias("year"), F.lit(d.month).alias("month"), F.lit(d.day).alias("day"))


def test_raw_landing_layout_and_pruned_read(spark):
    from tidewatch.sources.iocs import read_raw

    base = work_dir(spark, "test-raw")
    land_raw(documents(spark, "2024-03-01", ["x"]).unionByName(documents(spark, "2024-03-02", ["y", "z"])), base)
    land_raw(documents(spark, "2024-03-03", []), base)  # empty pull: nothing written
    import os
    assert sorted(os.listdir(base.removeprefix("file:") + "/year=2024")) == ["month=03"]
    df = read_raw(spark, base, after=dt.date(2024, 3, 1), inclusive=False)
    assert sorted(r.ioc for r in explode_raw(df).collect()) == ["y", "z"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_refresh_job_incremental(spark):
    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["a", "b"]), raw)
    r1 = run_ioc_refresh(spark, raw, table)
    assert r1.changed and r1.marker == dt.date(2024, 1, 1) and read_iocs(spark, table).count() == 2
    # Day right after the marker, with a repeated id inside the batch.
    land_raw(documents(spark, "2024-01-02", ["b", "c", "c"]), raw)
    r2 = run_ioc_refresh(spark, raw, table)
    assert r2.changed and r2.version == 1 and read_marker(spark, table) == dt.date(2024, 1, 2)
    t = {r.ioc: r for r in read_iocs(spark, table).collect()}
    assert set(t) == {"a", "b", "c"}
    assert t["b"].first_seen == dt.datetime(2024, 1, 1, 13, 0)  # kept from the table
    assert t["b"].last_seen == dt.datetime(2024, 1, 2, 15, 0)  # refreshed
    # Nothing new: no-op, table and marker unchanged.
    r3 = run_ioc_refresh(spark, raw, table)
    assert not r3.changed and r3.version == 1 and read_iocs(spark, table).count() == 3


def test_uncommitted_snapshot_is_invisible(spark):
    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["a"]), raw)
    run_ioc_refresh(spark, raw, table)
    # A crashed run wrote a snapshot but no commit row.
    cleaned(spark, [e("zzz")]).write.parquet(f"{table}/snapshots/0000000001")
    assert [r.ioc for r in read_iocs(spark, table).collect()] == ["a"]
    land_raw(documents(spark, "2024-01-02", ["b"]), raw)
    run_ioc_refresh(spark, raw, table)  # re-does version 1 over the debris
    assert sorted(r.ioc for r in read_iocs(spark, table).collect()) == ["a", "b"]


def test_reread_marker_day_picks_up_late_files(spark):
    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["a"]), raw)
    run_ioc_refresh(spark, raw, table)
    land_raw(documents(spark, "2024-01-01", ["late"]), raw)  # lands after the run, same day
    assert not run_ioc_refresh(spark, raw, table, reread_marker_day=False).changed
    r = run_ioc_refresh(spark, raw, table)
    assert r.changed and r.marker == dt.date(2024, 1, 1)
    assert sorted(x.ioc for x in read_iocs(spark, table).collect()) == ["a", "late"]


def test_merge_paths_agree_and_table_is_not_shuffled(spark):
    cur = merge_iocs(None, cleaned(spark, [e("a"), e("b", last="2024-01-03 00:00:00"), e("x")]))
    batch = cleaned(spark, [e("b", last="2024-01-05 00:00:00"), e("c"), e("c", first="2023-12-30 10:00:00"),
                            e("a", last="2023-01-01 00:00:00")])
    fast = merge_iocs(cur, batch, unique=True)
    slow = merge_iocs(cur, batch, broadcast_limit=1)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = fast._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_merge_folds_a_table_that_repeats_ids(spark):
    cur = cleaned(spark, [e("a"), e("a", last="2024-01-02 00:00:00"), e("b")])
    batch = cleaned(spark, [e("a", last="2024-01-03 00:00:00"), e("c")])
    got = [sorted(map(tuple, merge_iocs(cur, batch, limit).collect())) for limit in (None, 0)]
    assert got[0] == got[1] and len(got[0]) == 3


def test_payload_fields_outside_the_schema_are_kept(spark):
    from tidewatch.sinks.outputs import land_pulls

    folder, raw, table = (work_dir(spark, x) for x in ("test-pulls", "test-raw", "test-table"))
    payload = '{"query_status":"ok","data":[{"ioc":"a","asn":{"id":7},"note":"x","confidence_level":5},{"ioc":"b"}]}'
    spark.createDataFrame([(payload,)], "value string").write.text(folder)
    land_pulls(spark, folder, raw, dt.date(2024, 1, 1))
    land_pulls(spark, folder, raw, dt.date(2024, 1, 1))  # the same pull twice
    assert run_ioc_refresh(spark, raw, table).changed
    assert {r.ioc: r.extra for r in read_iocs(spark, table).collect()} == {"a": '{"asn":"{\\"id\\":7}","note":"x"}', "b": None}


def test_second_of_two_runs_from_one_version_fails(spark, monkeypatch):
    import pytest

    from tidewatch.plans import ioc_refresh as job

    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["a"]), raw)
    run_ioc_refresh(spark, raw, table)
    seen = job.last_commit(spark, table)
    land_raw(documents(spark, "2024-01-02", ["b"]), raw)
    run_ioc_refresh(spark, raw, table)
    land_raw(documents(spark, "2024-01-02", ["c"]), raw)
    monkeypatch.setattr(job, "last_commit", lambda *_: seen)  # the other run read version 0
    with pytest.raises(Exception, match="(?i)exists"):
        run_ioc_refresh(spark, raw, table)
    assert sorted(r.ioc for r in read_iocs(spark, table).collect()) == ["a", "b"]


def test_old_snapshots_go(spark):
    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        land_raw(documents(spark, day, [day]), raw)
        run_ioc_refresh(spark, raw, table, keep_snapshots=2)
    import os
    assert len(os.listdir(table.removeprefix("file:") + "/snapshots")) == 2 and read_iocs(spark, table).count() == 3


def test_folder_without_a_day_is_found_by_any_run(spark):
    raw, table = work_dir(spark, "test-raw"), work_dir(spark, "test-table")
    land_raw(documents(spark, "2024-01-01", ["a"]), raw)
    run_ioc_refresh(spark, raw, table)
    odd = documents(spark, "2024-01-01", ["odd"]).withColumn("month", F.lit(13))
    land_raw(odd, raw)
    assert run_ioc_refresh(spark, raw, table).changed and read_iocs(spark, table).count() == 2


def test_typed_explode_keeps_the_types_of_further_fields(spark):
    from tidewatch.operators.iocs import explode_raw_typed

    texts = ['{"ioc":"a","asn":{"id":7,"names":["x",null]},"note":"x","confidence_level":5,"tags":["t"],"is_compromised":true,"z":null}',
             '{"ioc":"b","confidence_level":"9.9","tags":[]}', "no json", "[1]", None, "{}", '{"ioc":{"deep":1},"tags":"one","b":1.50,"a":false}']
    raw = spark.createDataFrame([("ok", texts), ("none", None), ("none", [])], "query_status string, data array<string>")
    got = explode_raw_typed(raw).collect()
    assert len(got) == len(texts)
    a, b, *nothing, odd = got
    assert (a.ioc, a.confidence_level, a.tags, a.is_compromised) == ("a", "5", ["t"], True)
    assert a.extra == '{"asn":{"id":7,"names":["x",null]},"note":"x"}' and (b.confidence_level, b.tags, b.extra) == ("9.9", [], None)
    assert all(all(v is None for v in r) for r in nothing)
    assert odd.tags is None and odd.extra == '{"a":false,"b":1.5}'


def test_both_explodes_clean_to_the_same_rows(spark):
    from tidewatch.operators.iocs import explode_raw_typed
    from tidewatch.sources import fixtures as fx
    from tidewatch.sources.iocs import read_raw

    base = work_dir(spark, "test-raw")
    land_raw(fx.raw_documents(spark, "/root/testdata/sf0.001"), base)
    raw = read_raw(spark, base)
    one, two = (sorted(map(repr, clean_iocs(f(raw)).collect())) for f in (explode_raw, explode_raw_typed))
    assert one == two and len(one) > 20
