"""Run a query in Spark and its oracle in DuckDB and compare rows exactly."""

import math
from collections import Counter

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck(folder):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(repr(v)) + 0.0
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(_value(r[i])).__name__, _value(r[i])) for i in order) for r in rows)


def assert_same(df, connection, sql):
    relation = connection.sql(sql)
    assert sorted(df.columns) == sorted(relation.columns)
    expected = bag(relation.columns, relation.fetchall())
    actual = bag(df.columns, df.collect())
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"{sum(missing.values())} missing, e.g. {list(missing)[:2]}; "
        f"{sum(extra.values())} extra, e.g. {list(extra)[:2]}"
    )
    return sum(actual.values())
