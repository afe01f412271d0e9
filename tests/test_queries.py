"""Driver contract: entry() smoke, and every registered query against its
DuckDB oracle at sf0.001 (the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tidewatch.schemas import ALERT_SCHEMA
from tools.oracle_check import canon, duck

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ALERT_SCHEMA]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    from tidewatch.plans.catalog import REGISTRY

    assert set(ORACLES) <= set(QUERIES)
    assert all(q.sql for q in REGISTRY.values()) and set(REGISTRY) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(rows) > 0
        return
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert canon(df.columns, rows) == canon(names, res.fetchall())
