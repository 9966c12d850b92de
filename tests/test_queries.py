"""Every registered query with SQL must agree with it on the whole tables."""

import pytest

import __spark_entry__ as entry
from verification import registry
from verification.compare import compare, duckdb_connection

SQL = registry.SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    same, note = compare(registry.QUERIES[name](spark, sf_dir), con, SQL[name])
    assert same, note


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(registry.QUERIES)
