import random
import re
from collections import Counter, defaultdict

import pytest

from builders import rows, tables
from orderlens.plans import facts, reports
from orderlens.sources.star import star_tables

DONE = "Completed"


def plain(orders):
    """Retention cells by sets of months; (cohort, index) -> (active, size)."""
    months = defaultdict(set)
    for _, customer, date, status in orders:
        if status == DONE:
            months[customer].add(int(date[:4]) * 12 + int(date[5:7]) - 1)
    active = Counter((min(ms), m - min(ms)) for ms in months.values() for m in ms)
    return {k: (n, active[k[0], 0]) for k, n in active.items()}


def got(report):
    return {
        (int(r.cohort_month[:4]) * 12 + int(r.cohort_month[5:]) - 1, r.month_index): (r.active_customers, r.cohort_size)
        for r in report.collect()
    }


def made_orders(years, n=400, seed=3):
    rng = random.Random(seed)
    return [
        (i, rng.choice([None, *range(60)]), f"{rng.choice(years):04d}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}",
         rng.choice([DONE, DONE, "Cancelled"]))
        for i in range(n)
    ]


# One month, one word, the edges of words, and more years than bitmaps are kept for.
@pytest.mark.parametrize("years", [[2024], range(2020, 2025), range(1998, 2025), [1, 1970, 2024, 9999]])
@pytest.mark.parametrize("most_words", [0, 1, facts.MOST_WORDS])
def test_cells_equal_sets_of_months(spark, years, most_words):
    orders = made_orders(list(years))
    t = tables(spark, orders=orders)
    assert got(reports.retention(t, most_words=most_words)) == plain(orders)


def test_first_and_last_bit_of_a_word(spark):
    first, width = 2020 * 12, facts.WORD_MONTHS
    ends = [0, 1, width - 1, width, 2 * width - 1, 2 * width]
    orders = [
        (k, a * 10 + i, f"{(first + m) // 12:04d}-{(first + m) % 12 + 1:02d}-01", DONE)
        for k, (a, b, i, m) in enumerate((a, b, j, m) for a in range(6) for j, b in enumerate(ends) for m in (ends[a], b))
    ]
    t = tables(spark, orders=orders)
    assert got(reports.retention(t)) == plain(orders)
    assert got(reports.retention(t, most_words=0)) == plain(orders)


@pytest.mark.parametrize("dates", [["2024-01-05", None], [None]])
def test_orders_without_a_date_are_counted_alike(spark, dates):
    from orderlens.model import SCHEMAS, Tables
    from builders import moment

    found = [(i, i % 3, None if d is None else moment(d), DONE) for i, d in enumerate(dates * 4)]
    empty = tables(spark)
    t = Tables(empty.customers, empty.products, spark.createDataFrame(found, SCHEMAS["orders"]), empty.order_items)
    assert sorted(rows(reports.retention(t)), key=str) == sorted(rows(reports.retention(t, most_words=0)), key=str)


def test_one_shuffle_of_customers(spark, small):
    """No window and no distinct: a row of bitmaps per customer and map task is shuffled."""
    df = reports.retention(star_tables(spark, small), "F")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and text.count("FileScan") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", text)) == 1
    assert "partial_bit_or" in text
    cells = [line for line in text.split("\n") if "Exchange hashpartitioning(" in line and "customer_id" not in line]
    assert cells and all("cohort" in line for line in cells)


def test_both_ways_on_the_test_tables(spark, medium):
    t = star_tables(spark, medium)
    assert rows(reports.retention(t, "F")) == rows(reports.retention(t, "F", most_words=0))
