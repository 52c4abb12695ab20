"""Every query with an SQL formulation equals DuckDB on the small tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    ok, msg = compare(spark, con, name, entry.queries()[name], SQL[name], SF)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["metric", "value"]
