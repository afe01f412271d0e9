from pyspark.sql import functions as F

from tests.conftest import at, log_rows
from tests.test_ioc_match import base_iocs
from tidewatch.operators.detect import ioc_match
from tidewatch.operators.prefilter import key_bitmap, likely_matches
from tidewatch.operators.sketches import error_bound, merged, port_sketches, wide_scans, with_estimate


def scan_over_hosts(spark):
    """One source, one port each on 120 hosts within ten minutes; another source quiet."""
    rows = [dict(ts=at(4 * i), uid=f"U{i}", id_orig_h="10.0.0.1", id_resp_h=f"h{i}", id_resp_p=1000 + i) for i in range(120)]
    rows += [dict(ts=at(i), uid=f"V{i}", id_orig_h="10.0.0.2", id_resp_h="h", id_resp_p=80) for i in range(50)]
    return log_rows(spark, rows + [dict(ts=None, uid="N", id_orig_h="10.0.0.3", id_resp_p=1), dict(ts=at(1), uid="P", id_orig_h="10.0.0.4")])


def test_merged_sketches_count_over_destinations(spark):
    stored = port_sketches(scan_over_hosts(spark))
    got = {r.id_orig_h: r.port_count for r in with_estimate(merged(stored, "10 minutes")).collect()}
    assert set(got) == {"10.0.0.1", "10.0.0.2", "10.0.0.4"} and got["10.0.0.2"] == 1 and got["10.0.0.4"] == 0
    assert abs(got["10.0.0.1"] - 120) <= 120 * 0.065 + 1
    assert [r.id_orig_h for r in wide_scans(stored, "10 minutes", 50).collect()] == ["10.0.0.1"]


def test_union_equals_one_sketch_of_all(spark):
    logs = scan_over_hosts(spark)
    one = port_sketches(logs, "1 hour", ("id_orig_h",))
    both = merged(port_sketches(logs), "1 hour")
    key = lambda df: sorted((r.id_orig_h, r.port_count) for r in with_estimate(df).collect())
    assert key(one) == key(both)
    assert spark.range(1).select(error_bound(F.lit(100.0))).first()[0] < 8


def test_bitmap_keeps_all_matches_and_drops_most_others(spark):
    keys = spark.range(500).selectExpr("concat('k', id) as k").unionAll(spark.sql("select cast(null as string)"))
    rows = spark.range(4000).selectExpr("concat('k', id) as v", "id as _x")
    got = likely_matches(rows, "v", key_bitmap(keys, "k", 64), 64)
    assert got.columns == rows.columns
    kept = {r.v for r in got.collect()}
    assert kept >= {f"k{i}" for i in range(500)} and len(kept) < 1200
    assert key_bitmap(keys, "k", 64).count() <= 64
    assert likely_matches(rows, "v", key_bitmap(keys.limit(0), "k")).count() == 0


def test_prefilter_changes_no_alert_and_shuffles_fewer_rows(spark):
    rows = [dict(ts=at(i * 0.7), uid=f"C{i // 3}", log_path="dns", id_orig_h=f"10.10.10.{i % 7}",
                 id_resp_h="10.0.0.53", query=f"q{i}.example", answers=["7.7.7.7"]) for i in range(60)]
    df = log_rows(spark, rows)
    key = lambda d: sorted(tuple(r) for r in d.drop("alert_ts").collect())
    plain = ioc_match(df, base_iocs(spark), broadcast_limit=1, salt_buckets=4)
    cut = ioc_match(df, base_iocs(spark), broadcast_limit=1, salt_buckets=4, prefilter=True)
    assert key(cut) == key(plain) and len(key(plain)) > 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ioc_match(df, base_iocs(spark), broadcast_limit=1, salt_buckets=4, prefilter=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    lines = [x.lstrip(" :+-*()0123456789") for x in plan.splitlines()]
    join = next(i for i, x in enumerate(lines) if x.startswith("SortMergeJoin") and "match_value" in x)
    below = lines[join:]
    # The bitmap's broadcast join stands below the shuffle of the log values.
    assert any(x.startswith("BroadcastHashJoin [_at") for x in below)
