"""Every registered query against its DuckDB twin (sf0.001), and the entry smoke."""

import pytest

import __spark_entry__ as E
from tickwise.plans import catalog
from conftest import SF_SMALL
from oracle_check import compare, duck

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert len(SQL) >= len(QUERIES) - 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL.get(name), SF_SMALL)
    assert r["ok"] in (True, None), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["symbol", "asset_type", "anomaly_type"]
    assert df.count() >= 0
