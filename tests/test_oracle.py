"""Every registered query against its SQL, value by value."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry_point
from tickbars.plans.oracle import ORACLE as SQL
from tickbars.plans.registry import registered

QUERIES = registered()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns[:2] == ["name", "month"]
    assert result.count() > 0
