"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from tests import compare

DIRECTORY = "/root/testdata/sf0.001"
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.connect(DIRECTORY)


def test_entry(spark):
    rows = {r.time_window: r for r in entry_points.entry(spark).collect()}
    assert rows["all_time"].sessions == 581


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, connection, name):
    got = compare.spark_rows(QUERIES[name](spark, DIRECTORY))
    assert compare.differences(got, compare.sql_rows(connection, SQL[name])) is None
