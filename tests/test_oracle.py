"""Every registered query against its SQL on the same tables."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry

from conftest import SMALL

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
