"""Every registered query against its SQL, on all rows of the smallest tables."""

import pytest
from compare import connect, difference
from conftest import SMALL

import __spark_entry__ as entry
from folioforge.plans.oracle import oracle_sql
from folioforge.plans.queries import REGISTRY

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert difference(spark, con, SMALL, REGISTRY[name], SQL[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "title", "text"]
    assert df.count() > 0
