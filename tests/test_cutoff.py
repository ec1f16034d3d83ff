"""First rows by a searched cut-off, against a plain sort."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.operators.cutoff import first_rows
from orderlens.operators.durable import scratch
from orderlens.operators.sampling import sample_rows

_RANDOM = random.Random(5)
ROWS = [
    (i, _RANDOM.choice([None, 0, 0, 0, 0, -7, 5, _RANDOM.randrange(-(10**18), 10**18)]),
     Decimal(_RANDOM.randrange(-500, 500)) / 100 if i % 9 else None)
    for i in range(900)
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "id bigint, number bigint, price decimal(20,6)").repartition(7)


def expected(order, n):
    rows = list(ROWS)
    at = {"id": 0, "number": 1, "price": 2}
    for name, falls in reversed(order):
        rows.sort(key=lambda r: (r[at[name]] is not None, r[at[name]] or 0), reverse=falls)
    return sorted(r[0] for r in rows[:n])


@pytest.mark.parametrize("order", [
    [("number", False), ("id", False)], [("number", True), ("id", True)], [("price", True), ("id", False)],
    [("price", False), ("number", True), ("id", False)], [("id", True)],
])
@pytest.mark.parametrize("n", [1, 60, 333, 899])
def test_first_rows_equal_a_sort(table, order, n):
    with scratch() as held:
        found = first_rows(table, n, order, held=held, few=3, slots=5)
        assert found.columns == table.columns
        assert sorted(r.id for r in found.collect()) == expected(order, n)


def test_bounds(spark, table):
    order = [("number", False), ("id", False)]
    with scratch() as held:
        assert first_rows(table, 0, order, held=held, few=3, slots=5).count() == 0
        assert first_rows(table, 900, order, held=held, few=3).count() == 900
        assert first_rows(table, 5000, order, held=held, few=3).count() == 900
        assert first_rows(table.limit(0), 5, order, held=held, few=3).count() == 0
        # Rows that tie wholly: any of them, but as many as asked for.
        same = spark.range(500).select(F.lit(1).alias("number"), F.lit(None).cast("bigint").alias("id"))
        assert first_rows(same, 77, order, held=held, few=3, slots=5).count() == 77
    with pytest.raises(ValueError, match="name"):
        first_rows(table.withColumn("name", F.lit("x")), 5, [("name", False)])


def test_no_task_sorts_more_than_few_rows(table):
    """What is left to sort is a limit within the last slot, not the n rows."""
    with scratch() as held:
        found = first_rows(table, 600, [("id", False)], held=held, few=50, slots=5)
        plan = found._jdf.queryExecution().executedPlan().toString()
        limit = int(plan.split("TakeOrderedAndProject(limit=")[1].split(",")[0]) if "TakeOrdered" in plan else 0
        assert limit <= 50


def test_split_sample_equals_the_plain_one(spark):
    df = spark.range(5000).withColumn("text", F.concat(F.lit("é"), "id"))
    for key in ("id", "text"):
        with scratch() as held:
            split = sample_rows(df, 1200, F.col(key), "seed", split=True, held=held, few=10, slots=7)
            assert split.columns == df.columns
            plain = sample_rows(df, 1200, F.col(key), "seed")
            assert sorted(r.id for r in split.collect()) == sorted(r.id for r in plain.collect())
