"""Every query with SQL against DuckDB, on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, folder, con, name):
    assert difference(QUERIES[name](spark, folder), con, SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["household_id", "hour", "avg_kwh", "min_kwh", "max_kwh", "hour_count"]
