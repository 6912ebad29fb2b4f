"""Every registered query against its DuckDB statement on the smallest data set."""

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

from conftest import SMALL
from leadlens.bindings.queries import REGISTRY

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.connect(SMALL)


def test_every_query_has_a_statement():
    assert set(REGISTRY) <= set(SQL)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    ok, message, _rows = check.compare(spark, con, SMALL, QUERIES[name], SQL.get(name))
    assert ok, message
