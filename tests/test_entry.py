"""Driver contract and the DuckDB oracle for every catalogued query (at sf0.001)."""

import pytest

import __spark_entry__ as entry_mod
from vigil.plans.catalog import REGISTRY
from conftest import SF_SMALL
from oracle_check import compare, duck_connection


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "country" in df.columns


def test_every_query_has_oracle_or_is_marked():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert {n for n in REGISTRY if n not in o} == {"forecast_changepoint", "forecast_sparse"}


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql))
def test_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    status, detail = compare(rows, df.columns, cur.fetchall(), cols)
    assert status in ("OK", "APPROX"), f"{status} {detail}"
