"""Every registered query with check SQL returns the rows DuckDB returns."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, con, sf_dir, key):
    status, _, detail = compare(spark, con, key, sf_dir)
    assert status == "OK", detail


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sql_keys_are_queries():
    assert set(ORACLE) <= set(entry.queries())
