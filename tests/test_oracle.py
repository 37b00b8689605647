"""Every registered query against its DuckDB SQL on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os

import pytest

from oracle_compare import compare, duck

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(os.environ.get("CAIRN_FAST") == "1", reason="fast run")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, QUERIES[name], SQL[name], con)
    assert "error" not in r, r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
