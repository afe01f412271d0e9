"""Property tests: the indicator merge and the sizing helpers."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.functions.sizing import broadcast_if_small, measure
from tidewatch.operators.iocs import merge_iocs
from tests.test_iocs import cleaned, e

day = st.integers(min_value=1, max_value=9)
row = st.tuples(st.sampled_from(["a", "b", "c", "d"]), day, st.one_of(st.none(), day), st.sampled_from(["r1", "r2"]))
batch = st.lists(row, min_size=1, max_size=6)


def rows(spark, spec):
    return cleaned(spark, [e(i, first=f"2024-01-0{f} 10:00:00", reporter=r,
                             last=None if last is None else f"2024-01-0{last} 12:00:00") for i, f, last, r in spec])


@settings(max_examples=6, deadline=None)
@given(b1=batch, b2=batch)
def test_incremental_merge_properties(spark, b1, b2):
    t1 = merge_iocs(None, rows(spark, b1))
    t2 = merge_iocs(t1, rows(spark, b2))
    got = {r.ioc: r for r in t2.collect()}
    # one row per id, covering every id ever seen
    assert t2.count() == len(got) == len({x[0] for x in b1 + b2})
    # last_seen is the max over everything merged, so it never decreases
    first = {r.ioc: r for r in t1.collect()}
    for ioc, r in got.items():
        seen = [dt.datetime(2024, 1, (last or f), 12 if last else 10) + dt.timedelta(hours=3)
                for i, f, last, _ in b1 + b2 if i == ioc]
        assert r.last_seen == max(seen)
        if ioc in first:  # attributes come from the table row once it exists
            assert (r.first_seen, r.reporter) == (first[ioc].first_seen, first[ioc].reporter)
            assert r.last_seen >= first[ioc].last_seen
    # idempotent
    again = merge_iocs(t2, rows(spark, b2))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, t2.collect()))


def test_measure_and_broadcast_decision(spark):
    df = spark.createDataFrame([("abc", [1, 2]), ("", None), (None, [3])], "s string, a array<int>")
    m = measure(df)
    assert m.rows == 3 and m.bytes >= 3 + 3 * 8
    hinted, _ = broadcast_if_small(df, limit=10 ** 9)
    plain, m1 = broadcast_if_small(df, limit=1)
    assert not m1.exact and m1.rows == 3  # ruled out by the row count alone
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()
