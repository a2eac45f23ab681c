"""Every registered query against its SQL on the smallest data."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - {"model_registry"}))
def test_query_without_sql(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
