"""Every registered query against DuckDB on the small test tables."""

import pytest

import __spark_entry__ as entry
from compare import assert_same, duck

QUERIES, ORACLES = entry.core_queries(), entry.core_oracle_sql()


@pytest.fixture(scope="module")
def connection(medium):
    with duck(medium) as c:
        yield c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, medium, connection):
    assert assert_same(QUERIES[name](spark, medium), connection, ORACLES[name]) > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_month", "total_revenue", "total_orders"]
    assert df.count() > 0
