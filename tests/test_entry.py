"""Every query that has SQL against it, on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
from checks.compare import connect, differences
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF)
    assert differences(df, duck, spark_entry.oracle_sql()[name]) == []
