import ipaddress
import random

import pytest

from tidewatch.operators.prefixes import address_bits, invalid_segments, with_segment

ADDRESSES = ["10.0.0.1", "255.255.255.255", "0.0.0.0", "::", "::1", "1::", "2001:DB8::8:800:200C:417A", "fe80::1%eth0", "::ffff:10.0.0.1", "1:2:3:4:5:6:7:8",
             "1:2:3:4:5:6:1.2.3.4", " 10.0.0.7 "]
NONE = [None, "", "x", "10.0.0", "10.0.0.256", "1:2:3", "1::2::3", "1:2:3:4:5:6:7:8:9", ":::", "12345::", "g::1", "1:2:3:4:5:6:7::8:9", "::1.2.3.400", ":"]


def bits(text):
    a = ipaddress.ip_address(text.strip().split("%")[0])
    return f"{a.version}{int(a):0{a.max_prefixlen}b}"


def test_addresses_become_their_bits(spark):
    df = spark.createDataFrame([(t,) for t in ADDRESSES + NONE], "ip string")
    got = [r[0] for r in df.select(address_bits("ip")).collect()]
    assert got == [bits(t) for t in ADDRESSES] + [None] * len(NONE)


def brute(ip, segments):
    try:
        a = ipaddress.ip_address(ip.strip().split("%")[0])
    except (AttributeError, ValueError):
        return None
    hits = []
    for name, cidr in segments:
        try:
            n = ipaddress.ip_network(cidr, strict=False)
        except (TypeError, ValueError):
            continue
        if n.version == a.version and a in n:
            hits.append((-n.prefixlen, name))
    return min(hits)[1] if hits else None


@pytest.mark.parametrize("limit", [None, 0])
def test_longest_prefix_wins(spark, limit):
    r = random.Random(3)
    v4 = lambda: f"{r.choice((10, 11))}.{r.randint(0, 2)}.{r.randint(0, 3)}.{r.randint(0, 255)}"
    v6 = lambda: f"2001:db8:{r.randint(0, 3):x}::{r.randint(0, 9):x}"
    ips = [v4() for _ in range(120)] + [v6() for _ in range(60)] + ADDRESSES + NONE + ["10.0.0.1"] * 50
    segments = [(f"n{i}", f"{v4()}/{r.randint(7, 32)}") for i in range(60)] + [(f"m{i}", f"{v6()}/{r.randint(16, 128)}") for i in range(40)]
    segments += [("all", "0.0.0.0/0"), ("b", "10.0.0.0/24"), ("a", "10.0.0.9/24"), ("one", "10.0.0.1"), ("bad", "10.0.0.0/33"), ("bad", "::/129"), ("bad", "x"), ("bad", None), ("bad", "1.2.3.4/y")]
    df = spark.createDataFrame(list(enumerate(ips)), "i int, ip string")
    table = spark.createDataFrame(segments, "name string, cidr string")
    got = {r.i: r.seg for r in with_segment(df, "ip", table, "seg", limit).collect()}
    assert got == {i: brute(ip, segments) for i, ip in enumerate(ips)}
    assert invalid_segments(table) == 5


def test_empty_tables(spark):
    none = spark.createDataFrame([], "name string, cidr string")
    one = spark.createDataFrame([("10.0.0.1",)], "ip string")
    assert with_segment(one, "ip", none).first().segment is None
    assert with_segment(one.limit(0), "ip", none, limit=0).count() == 0


def test_small_table_shuffles_no_log_row(spark):
    df = spark.range(100).selectExpr("id", "concat('10.0.0.', id) as ip")
    table = spark.createDataFrame([("a", "10.0.0.0/26"), ("b", "10.0.0.0/8")], "name string, cidr string")
    plan = with_segment(df, "ip", table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
