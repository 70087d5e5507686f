"""Every registered query with SQL gives the same rows as that SQL."""

import pytest

import __spark_entry__ as entry
from tests.check import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_sql_names_are_registered():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
