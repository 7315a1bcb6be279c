"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from walletflow.plans.queries import QUERIES as ENGINE
from walletflow.plans.oracle_compare import compare, duckdb_connection
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_engine_query_has_an_oracle():
    assert set(ENGINE) <= set(ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["chain", "address", "symbol", "balance", "price", "usd"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert res["values_match"], res
