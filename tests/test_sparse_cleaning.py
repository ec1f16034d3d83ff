"""Cleaning that moves few rows, counts taken by the jobs that write, scoped intermediates."""

import os
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from builders import rows
from conftest import ROOT
from orderlens.operators import dedup, durable
from orderlens.operators.dedup import collapse_copies, collapse_rare_copies
from orderlens.operators.durable import Scratch, observed, scratch, warehouse_root
from orderlens.operators.keysets import flag_known, flag_known_but_few
from orderlens.plans import cleaning
from orderlens.sources.star import AS_OF, raw_star_tables

ODD = [
    (1, "a", 0.0), (1, "a", -0.0), (1, "a", float("nan")), (1, "a", float("nan")), (None, "a", 1.0), (1, None, 1.0),
    (None, None, None), (None, None, None), (None, None, None), (2, "", None), (2, None, None), (3, "b", 2.0),
]
SCHEMA = "k bigint, t string, x double"


def bag(df):
    return Counter(tuple("nan" if v != v else v for v in row) for row in rows(df))


def few_hashes(columns):
    """Hashes that clash for most rows."""
    return F.coalesce(F.length("t"), F.lit(0)).cast("bigint"), F.lit(1).cast("bigint")


@pytest.mark.parametrize("hashes", [dedup.row_hashes, few_hashes, lambda c: (F.lit(1), F.lit(2))])
@pytest.mark.parametrize("most", [0, dedup.BROADCAST_HASHES])
def test_rare_copies_are_those_of_a_grouping(spark, hashes, most):
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    with scratch() as held:
        found = collapse_rare_copies(df, held, hashes=hashes, most=most)
        assert found.columns == [*df.columns, "copies"]
        assert bag(found) == bag(collapse_copies(df)) and found.count() == 8


def test_rare_copies_of_an_empty_table(spark):
    with scratch() as held:
        assert collapse_rare_copies(spark.createDataFrame([], SCHEMA), held).count() == 0


def test_rows_with_nulls_in_other_places_have_other_hashes(spark):
    df = spark.createDataFrame([(1, None), (None, 1)], "a bigint, b bigint")
    assert df.select(*[h.alias(f"h{i}") for i, h in enumerate(dedup.row_hashes(df.columns))]).distinct().count() == 2


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_few_unknown_keys(spark, most):
    df = spark.createDataFrame([(i % 9 if i % 5 else None, i) for i in range(60)], "k bigint, i int")
    keys = spark.createDataFrame([(i,) for i in (0, 1, 2, 3, 3, 5, 6, 7, None, 40)], "k bigint")
    with scratch() as held:
        found = flag_known_but_few(df, "k", keys, "known", held, most=most)
        assert bag(found) == bag(flag_known(df, "k", keys, "known"))
        nobody = flag_known_but_few(df, "k", keys.limit(0), "known", held, most=most)
        assert nobody.filter("known").count() == 0 and nobody.count() == 60



def test_lines_do_not_move(spark, small):
    """In the final plan only rows with copies are shuffled: the lookups are broadcasts."""
    raw = raw_star_tables(spark, small)
    with scratch() as held:
        clean = cleaning.clean_order_items(raw, AS_OF, held=held)
        text = clean._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1 and text.count("BroadcastHashJoin") >= 4
        plain = cleaning.clean_order_items(raw, AS_OF)
        assert bag(clean) == bag(plain) and clean.columns == plain.columns


@pytest.mark.parametrize("judge", ["customers", "orders"])
def test_judges_agree_with_their_lazy_form(spark, small, judge):
    raw = raw_star_tables(spark, small)
    with scratch() as held:
        if judge == "customers":
            plain, found = cleaning.judge_customers(raw.customers), cleaning.judge_customers(raw.customers, held)
        else:
            given = raw.orders, raw.customers, AS_OF
            plain, found = cleaning.judge_orders(*given), cleaning.judge_orders(*given, held=held)
        assert found.columns == plain.columns and bag(found) == bag(plain)


def held_tables(spark):
    root = durable.durable_root(spark)
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_report_leaves_nothing_behind(spark, small):
    before = held_tables(spark)
    report = cleaning.cleaning_report(raw_star_tables(spark, small), AS_OF)
    assert held_tables(spark) == before and report.count() == 26
    run = cleaning.clean_all(raw_star_tables(spark, small), AS_OF)
    assert len(held_tables(spark) - before) == 4
    assert bag(run.report) == bag(report)


def test_report_reads_each_table_once(spark, small, monkeypatch):
    """Each judged frame scans its raw table once; customers give bare keys to orders as well."""
    plans = []
    seen = cleaning.observed

    def spy(df, metrics):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return seen(df, metrics)

    monkeypatch.setattr(cleaning, "observed", spy)
    cleaning.cleaning_report(raw_star_tables(spark, small), AS_OF)
    text = "\n".join(plans)
    assert len(plans) == 4
    for column, scans in (("l_orderkey", 1), ("p_type", 1), ("o_orderdate", 1), ("c_name", 1)):
        assert sum("FileScan" in line and column in line for line in text.split("\n")) == scans


RETRIED = """
import os, sys
from pyspark.sql import SparkSession, functions as F
from orderlens.operators.durable import observed
marker, warehouse = sys.argv[1:]
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config(
    "spark.sql.warehouse.dir", warehouse).getOrCreate()

def flaky(batches):
    for batch in batches:
        yield batch
    if not os.path.exists(marker):  # after its rows were counted
        open(marker, "w").close()
        raise RuntimeError("lost")

df = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 100).alias("k")).count()
counted, counts = observed(df, {"n": F.count(F.lit(1)), "total": F.sum("count")})
counted.mapInArrow(flaky, counted.schema).write.parquet(warehouse + "/out")
print(counts(), os.path.exists(marker))
spark.stop()
"""


def test_a_task_that_is_tried_again_counts_once(tmp_path):
    """In a session of its own, since tasks of the shared one are tried once."""
    environment = os.environ | {"PYTHONPATH": ROOT}
    done = subprocess.run(
        [sys.executable, "-c", RETRIED, str(tmp_path / "failed"), str(tmp_path / "warehouse")],
        env=environment, capture_output=True, text=True, timeout=240,
    )
    assert done.stdout.strip().endswith("{'n': 100, 'total': 1000} True"), done.stderr[-2000:]


def test_scratch_drops_after_an_error(spark):
    before = held_tables(spark)
    with pytest.raises(ZeroDivisionError), scratch() as held:
        stored, n = held.counted(spark.range(7))
        assert n == 7 == stored.count()
        1 / 0
    assert held_tables(spark) == before


def test_empty_tables_are_counted(spark):
    held = Scratch()
    assert held.counted(spark.range(5).filter("id > 9"))[1] == 0
    assert held.counted(spark.range(0))[1] == 0
    held.drop()


def test_local_warehouse_is_refused_on_a_cluster():
    assert warehouse_root("/w/", "file", "local[4]") == "/w/_intermediate"
    assert warehouse_root("s3a://b/w", "s3a", "yarn") == "s3a://b/w/_intermediate"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        warehouse_root("/w", "file", "spark://host:7077")
