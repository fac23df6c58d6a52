"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from carelattice.harness import catalog
from tests.compare import connect, difference

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_own_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_entry_returns_rows(spark):
    assert not entry.entry(spark).isEmpty()
