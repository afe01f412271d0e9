"""Indicator match: candidates, key rules, severity, grouping."""

import pytest

from tidewatch.functions.columns import match_key
from tidewatch.operators.detect import ioc_candidates, ioc_match
from tests.conftest import at, log_rows

IOC_DDL = "ioc string, ioc_type string, reporter string, confidence_level int, tags array<string>, is_compromised boolean"


def iocs(spark, rows):
    return spark.createDataFrame(rows, IOC_DDL)


@pytest.mark.parametrize("ioc,ioc_type,key", [
    ("1.2.3.4:443", "ip:port", "1.2.3.4"),
    ("http://evil.example/a/b", "url", "evil.example"),
    ("https://evil.example:8443/x", "url", "evil.example:8443"),
    ("evil.example/path", "url", "evil.example"),
    ("Evil.Example", "domain", "Evil.Example"),
])
def test_match_key_rules(spark, ioc, ioc_type, key):
    df = spark.createDataFrame([(ioc, ioc_type)], "ioc string, ioc_type string")
    assert df.select(match_key()).first()[0] == key


@pytest.mark.parametrize("ioc,ioc_type,key", [
    ("https://user@Evil.Example:8443/x", "url", "evil.example"),
    ("ftp://files.example/x", "url", "files.example"),
    ("[2001:db8::1]:443", "ip:port", "2001:db8::1"),
    ("http://[2001:DB8::1]/x", "url", "2001:db8::1"),
])
def test_strict_match_key(spark, ioc, ioc_type, key):
    df = spark.createDataFrame([(ioc, ioc_type)], "ioc string, ioc_type string")
    assert df.select(match_key(strict=True)).first()[0] == key


def base_iocs(spark, compromised=False):
    return iocs(spark, [
        ("http://bad.example/x", "url", "repA", 70, ["c2", "x"], compromised),
        ("http://bad.example/y", "url", None, 90, None, False),
        ("6.6.6.6:80", "ip:port", "repB", 40, ["scan"], None),
        ("7.7.7.7", "ip", "repC", 10, ["dns"], False),
    ])


@pytest.mark.parametrize("row", [
    dict(log_path="dns", query="bad.example", answers=["1.1.1.1"]),
    dict(log_path="dns", query="ok.example", answers=["1.1.1.1", "7.7.7.7"]),
    dict(log_path="http", host="bad.example"),
    dict(log_path="conn", id_resp_h="6.6.6.6"),
])
def test_each_candidate_field_matches(spark, row):
    r = dict(ts=at(1), uid="C1", id_orig_h="10.10.10.2", id_resp_h="9.9.9.9")
    r.update(row)
    out = ioc_match(log_rows(spark, [r]), base_iocs(spark)).collect()
    assert len(out) == 1 and out[0].alert_type == "IOC Match" and out[0].log_uid == "C1"


def test_orig_ip_is_not_a_candidate(spark):
    r = dict(ts=at(1), uid="C1", log_path="conn", id_orig_h="6.6.6.6", id_resp_h="9.9.9.9")
    assert ioc_match(log_rows(spark, [r]), base_iocs(spark)).count() == 0


@pytest.mark.parametrize("flag,severity", [(True, "High"), (False, "Medium"), (None, "Medium")])
def test_severity_follows_compromised_flag(spark, flag, severity):
    r = dict(ts=at(1), uid="C1", log_path="http", id_orig_h="10.10.10.2", id_resp_h="9.9.9.9", host="bad.example")
    out = ioc_match(log_rows(spark, [r]), base_iocs(spark, flag)).first()
    assert out.severity == severity


def test_aggregates_over_all_hits(spark):
    r = dict(ts=at(1), uid="C1", log_path="http", id_orig_h="10.10.10.2", id_resp_h="9.9.9.9", host="bad.example")
    out = ioc_match(log_rows(spark, [r]), base_iocs(spark)).first()
    assert out.ioc_value == ["http://bad.example/x", "http://bad.example/y"]
    assert out.ioc_source == ["repA"]  # null reporter dropped
    assert out.ioc_score == 90
    assert out.tags == ["c2", "x"]  # null tags treated as empty


def test_flow_records_in_one_window_make_one_alert(spark):
    rows = [
        dict(ts=at(1.0), uid="C9", log_path="dns", id_orig_h="10.10.10.2", id_resp_h="10.0.0.53",
             query="bad.example", answers=["6.6.6.6"]),
        dict(ts=at(1.5), uid="C9", log_path="conn", id_orig_h="10.10.10.2", id_resp_h="6.6.6.6"),
        dict(ts=at(2.0), uid="C9", log_path="http", id_orig_h="10.10.10.2", id_resp_h="6.6.6.6", host="bad.example"),
    ]
    out = ioc_match(log_rows(spark, rows), base_iocs(spark)).collect()
    assert len(out) == 1
    a = out[0]
    assert a.event_ts == at(1.0) and a.resp_ip == "10.0.0.53"  # first record by time
    assert a.ioc_value == ["6.6.6.6:80", "http://bad.example/x", "http://bad.example/y"]
    assert a.ioc_source == ["repA", "repB"] and a.tags == ["c2", "scan", "x"]


def test_windows_split_alerts(spark):
    rows = [dict(ts=at(s), uid="C9", log_path="http", id_orig_h="o", id_resp_h="r", host="bad.example")
            for s in (1.0, 4.9, 5.0)]
    assert ioc_match(log_rows(spark, rows), base_iocs(spark)).count() == 2


@pytest.mark.parametrize("answers", [None, [], ["1.1.1.1", "2.2.2.2"]])
def test_answers_shapes_keep_other_candidates(spark, answers):
    r = dict(ts=at(1), uid="C1", log_path="dns", id_orig_h="o", id_resp_h="9.9.9.9", query="bad.example", answers=answers)
    assert ioc_match(log_rows(spark, [r]), base_iocs(spark)).count() == 1
    n = ioc_candidates(log_rows(spark, [r])).count()
    assert n == 2 * max(1, len(answers or [])) + len(answers or [])


def test_duplicates_do_not_change_alerts(spark):
    rows = [dict(ts=at(1), uid="C1", log_path="http", id_orig_h="o", id_resp_h="r", host="bad.example")]
    one = ioc_match(log_rows(spark, rows), base_iocs(spark)).drop("alert_ts").collect()
    two = ioc_match(log_rows(spark, rows * 3), base_iocs(spark), dedup=True).drop("alert_ts").collect()
    assert one == two


def test_indicator_side_is_one_row_per_key_and_broadcast(spark):
    from tidewatch.operators.iocs import prepared_keys

    keys = prepared_keys(base_iocs(spark))
    t = keys.table
    assert keys.small and t.count() == t.select("ioc_for_match").distinct().count() == 3
    r = dict(ts=at(1), uid="C1", log_path="http", id_orig_h="o", id_resp_h="r", host="bad.example")
    plan = ioc_match(log_rows(spark, [r]), base_iocs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_oversized_indicator_side_is_not_broadcast(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = dict(ts=at(1), uid="C1", log_path="http", id_orig_h="o", id_resp_h="r", host="bad.example")
        df = ioc_match(log_rows(spark, [r]), base_iocs(spark), broadcast_limit=10)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and df.count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_salted_shuffle_join_equals_broadcast(spark):
    """A hot match value (the same answer in every DNS row) through the
    salted shuffle join gives the same alerts as the broadcast join."""
    rows = [dict(ts=at(i * 0.7), uid=f"C{i // 3}", log_path="dns", id_orig_h=f"10.10.10.{i % 7}",
                 id_resp_h="10.0.0.53", query=f"q{i}.example", answers=["7.7.7.7"]) for i in range(60)]
    df = log_rows(spark, rows)
    key = lambda d: sorted(tuple(r) for r in d.drop("alert_ts").collect())
    base = ioc_match(df, base_iocs(spark))
    salted = ioc_match(df, base_iocs(spark), broadcast_limit=1, salt_buckets=4)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert key(salted) == key(base) and len(key(base)) > 1


def test_lists_stay_out_of_the_aggregate_of_log_rows(spark):
    """One explode of the log rows; the (window, uid) aggregate holds keys."""
    r = dict(ts=at(1), uid="C1", log_path="dns", id_orig_h="o", id_resp_h="9.9.9.9", query="bad.example", answers=["9.9.9.9"] * 50)
    df = ioc_match(log_rows(spark, [r]), base_iocs(spark))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    names = [x.lstrip(" :+-*()0123456789") for x in plan]
    rows = [x for x in names if "partial_collect_set(match_value" in x]
    assert rows and not any("ioc_values" in x for x in rows)
    assert sum(x.startswith("Generate explode(array_distinct") for x in names) == 1
    from tidewatch.operators.detect import match_values

    assert sorted(x.match_value for x in match_values(log_rows(spark, [r])).collect()) == ["9.9.9.9", "bad.example"]


def test_strict_matching_normalises_both_sides(spark):
    rows = [dict(ts=at(i), uid=f"C{i}", log_path="http", id_orig_h="o", id_resp_h="r", host=h)
            for i, h in enumerate(["BAD.Example:8080", "Bad.Example", " bad.example ", "bad.example.org"])]
    rows.append(dict(ts=at(9), uid="C9", log_path="dns", id_orig_h="o", id_resp_h="[2001:DB8::1]:53"))
    extra = spark.createDataFrame([("[2001:db8::1]:443", "ip:port", "r", 1, None, None), ("/", "url", "r", 1, None, None)], base_iocs(spark).schema)
    iocs = base_iocs(spark).unionByName(extra)
    strict = {r.log_uid for r in ioc_match(log_rows(spark, rows), iocs, strict_keys=True).collect()}
    assert strict == {"C0", "C1", "C2", "C9"}
    assert {r.log_uid for r in ioc_match(log_rows(spark, rows), iocs).collect()} == set()


@pytest.mark.parametrize("strict", [False, True])
def test_an_indicator_without_host_matches_nothing(spark, strict):
    iocs = spark.createDataFrame([("/", "url", "r", 1, None, None)], base_iocs(spark).schema)
    r = dict(ts=at(1), uid="C1", log_path="http", id_orig_h="o", id_resp_h="r", host="")
    assert ioc_match(log_rows(spark, [r]), iocs, strict_keys=strict).count() == 0
