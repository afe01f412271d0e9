"""Plan shape: every hash shuffle is fed by a partial aggregate, so a hot
key never ships its raw rows to one task; scans are pruned."""

import pytest

from tidewatch.operators.detect import ioc_match, pair_activity
from tidewatch.operators.iocs import merge_iocs
from tidewatch.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


def physical(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def pre_aggregated(line):
    """A partial aggregate, or a keys-only (distinct) one: both combine map-side."""
    return "Aggregate" in line and ("partial_" in line or "functions=[]" in line)


def hash_shuffle_children(plan):
    lines = [ln for ln in plan.splitlines() if ln.strip()]
    op = [ln.lstrip(" :+-*()0123456789") for ln in lines]
    return [lines[i + 1] for i, o in enumerate(op) if o.startswith("Exchange hashpartitioning")]


@pytest.mark.parametrize("build", [
    lambda s: pair_activity(fx.net(s, SF), exact=True),
    lambda s: pair_activity(fx.net(s, SF), exact=False),
    lambda s: pair_activity(fx.net(s, SF), kinds=("scan",)),
    lambda s: ioc_match(fx.net(s, SF), fx.iocs(s, SF)),
])
def test_detector_shuffles_are_pre_aggregated(spark, build):
    children = hash_shuffle_children(physical(build(spark)))
    assert children, "expected at least one aggregation shuffle"
    for child in children:
        assert pre_aggregated(child), child


def test_scan_only_pairs_stay_hash_based(spark):
    plan = physical(pair_activity(fx.net(spark, SF), kinds=("scan",)))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_merge_shuffle_is_pre_aggregated(spark):
    from tidewatch.plans.catalog import _current, _increment

    plan = physical(merge_iocs(_current(spark, SF), _increment(spark, SF), unique=True))
    assert "LeftOuter" in plan and "LeftSemi" in plan  # table joins the broadcast increment map-side
    for child in hash_shuffle_children(plan):
        # the checkpointed increment (one row per id, increment-sized) may be
        # shuffled for the anti-join; anything else is pre-aggregated
        assert pre_aggregated(child) or "Scan ExistingRDD" in child, child


def test_scans_read_only_needed_columns(spark):
    plan = physical(pair_activity(fx.net(spark, SF, hosts=False)))
    assert "html" not in plan and "Join" not in plan and "RoundRobin" not in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double,props:string>" in plan
