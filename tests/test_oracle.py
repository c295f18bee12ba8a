"""Every registered query against its DuckDB oracle on sf0.01, and the entry smoke run."""

import os

import pytest

from oracle_check import compare, duck
from conftest import SF001

pytestmark = pytest.mark.skipif(not os.path.isdir(SF001), reason="driver tables not present")


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["r_name", "F", "O"]


def test_every_query_has_oracle_or_is_declared(spark):
    from __spark_entry__ import oracle_sql, queries
    from portmart.plans.catalog import QUERIES
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())  # each of the library's own queries has its SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def _keys():
    from __spark_entry__ import queries
    from portmart.plans.catalog import QUERIES
    return sorted(set(QUERIES) & set(queries()))  # the others are tested beside their operators


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, con, key):
    from __spark_entry__ import oracle_sql, queries
    r = compare(spark, key, queries()[key], oracle_sql().get(key), SF001, con)
    assert r["status"] == "match", r
