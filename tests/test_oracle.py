"""Every query with an SQL twin gives the same rows in DuckDB."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_comparison_sees_differences(spark, con):
    assert differences(spark.sql("select 1 as a"), con, "select 2 as a")
    assert differences(spark.sql("select 1 as a"), con, "select 1 as b")
    assert differences(spark.sql("select 1 as a"), con, "select 1 as a union all select 1")
    assert not differences(spark.sql("select 1 as a, null as b"), con, "select null as b, 1 as a")
