"""Every registered query against its DuckDB oracle on the smallest driver scale."""

import os
import re

import pytest

from oracle.compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _keys():
    from __spark_entry__ import oracle_sql, queries

    # Training-data queries without SQL have brute-force tests of their own.
    return [k for k in queries() if k in oracle_sql() or not re.match(r"op\d+_|pipeline$", k)]


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, con, key):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[key](spark, SF)
    assert key in oracle_sql(), "a query without SQL"
    r = compare(df, con, oracle_sql()[key])
    assert r["ok"], r


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "otd_status" in df.columns
