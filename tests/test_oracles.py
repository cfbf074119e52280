"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from meteora.plans.catalog import QUERIES as CATALOG
from oracle_check import check, duck

from paths import SF_SMALL

# the optional subpackage tests its own queries
QUERIES = {k: f for k, f in entry.queries().items() if k in CATALOG}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(CATALOG) and set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    ok, msg = check(spark, key, QUERIES[key], SQL.get(key), SF_SMALL, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["id", "date", "tmax"]
