"""Registered queries against their SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from carelattice.llm import queries
from tests.compare import connect, difference


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), con, queries.ORACLE[name]) is None
