"""Lines tested by a broadcast key filter before they are folded."""

import pytest
from pyspark.sql import functions as F

from orderlens.model import Tables
from orderlens.operators import keysets
from orderlens.operators.durable import scratch
from orderlens.plans import facts, reports
from orderlens.sources.star import star_tables


@pytest.fixture(scope="module")
def held():
    with scratch() as scope:
        yield scope


@pytest.mark.parametrize("keys", [0, 1, 5_000, 60_000])
def test_no_key_is_lost_and_few_others_pass(spark, held, keys):
    blocks = keysets.filter_blocks(keys)
    known = spark.range(keys).select((F.col("id") * 3).alias("key"))
    found = held.store(keysets.key_filter(known.union(known.limit(1)).union(spark.sql("SELECT null")), "key", blocks))
    assert found.count() == blocks and found.agg(F.min(F.size("words"))).first()[0] == 512
    rows = spark.range(4 * keys + 10).select((F.col("id") * 3).alias("key")).union(spark.sql("SELECT null"))
    passed = keysets.maybe_known(rows, "key", found, blocks)
    assert passed.columns == ["key"]
    counts = passed.agg(F.count_if(F.col("key") < 3 * keys).alias("known"), F.count(F.lit(1)).alias("all")).first()
    assert counts.known == keys and passed.filter("key IS NULL").isEmpty()
    assert counts["all"] - keys <= 0.06 * 3 * keys + 1


def test_text_keys(spark, held):
    known = spark.range(100).select(F.concat(F.lit("k"), "id").alias("key"))
    found = held.store(keysets.key_filter(known, "key", 1))
    rows = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1).alias("_block"))
    kept = {r.key for r in keysets.maybe_known(rows, "key", found, 1).collect()}
    assert {f"k{i}" for i in range(100)} <= kept and len(kept) < 250


def test_size_is_bounded():
    assert keysets.filter_blocks(0) == keysets.filter_blocks(1) == 1
    assert keysets.filter_blocks(10**6) == 256
    assert keysets.filter_blocks(10**12) * keysets.BLOCK_BITS == keysets.MOST_BITS


def test_reports_stay_the_same(spark, small, held):
    tables = star_tables(spark, small)
    few = facts.lines_of_completed(tables, held, "F")
    lines = few.order_items.count()
    done = facts.completed_orders(tables, "F").select("order_id")
    wanted = tables.order_items.join(done, "order_id", "left_semi").count()
    assert wanted <= lines < wanted + 0.1 * tables.order_items.count()
    for report in (reports.revenue_by_customer, reports.revenue_by_category, reports.revenue_by_month,
                   reports.top_products_qty, reports.aov_by_segment, reports.rank_within_customer):
        assert report(few, "F").collect() == report(tables, "F").collect()


def test_filter_comes_before_the_fold(spark, small, held):
    few = facts.lines_of_completed(star_tables(spark, small), held, "F")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for name in names:
            spark.conf.set(name, "-1")
        plan = facts.order_totals(few, "F")._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            spark.conf.unset(name)
    # From the scan up: the broadcast test, then the fold in each task, then the shuffle.
    fold, test = plan.index("partial_sum(amount_micros"), plan.index("LeftSemi")
    assert fold < test and "Exchange hashpartitioning" not in plan[fold:test]


def test_left_alone_where_it_does_not_pay(spark, small, held, monkeypatch):
    tables = star_tables(spark, small)
    assert facts.lines_of_completed(tables, held, "F", most=0.1) is tables
    monkeypatch.setattr(keysets, "MOST_BITS", keysets.BLOCK_BITS)
    monkeypatch.setattr(facts.keysets, "filter_blocks", lambda n: 0)
    assert facts.lines_of_completed(tables, held, "F") is tables


def test_empty_orders(spark, small, held):
    t = star_tables(spark, small)
    empty = Tables(t.customers, t.products, t.orders.limit(0), t.order_items)
    assert reports.revenue_by_month(facts.lines_of_completed(empty, held, "F"), "F").count() == 0
