"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import os

import pytest

from __spark_entry__ import entry
from tests.oracle_compare import compare, duck
from ticketflow.plans.catalog import QUERIES
from ticketflow.plans.oracle import ORACLE

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(ROOT)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sql = ORACLE.get(key)
    if sql is None:
        assert QUERIES[key](spark, ROOT).count() >= 0
        return
    r = compare(spark, con, ROOT, QUERIES[key], sql)
    assert r["columns"], r
    assert r["rows"], r
    assert r["hash"], r


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["district", "median_days", "resolved_n"]
    assert df.count() >= 0
