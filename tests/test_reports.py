import math

import pytest
from pyspark.sql import functions as F

from builders import rows, tables
from orderlens import list_reports, run_report, save_report
from orderlens.plans import reports
from orderlens.sources.star import AS_OF, COMPLETED_STATUS, star_tables

DONE = "Completed"


def test_order_without_lines_counts_in_cohorts_only(spark):
    t = tables(
        spark, customers=[(1, "A", "VIP"), (2, "B", "VIP")], products=[(1, "p", "Toys", 5)],
        orders=[(1, 1, "2024-01-05", DONE), (2, 2, "2024-01-06", DONE)], items=[(1, 1, 2, 5.00)],
    )
    assert rows(reports.revenue_by_customer(t)) == [(1, "A", "VIP", 10.0, 1)]
    assert rows(reports.cohort_sizes(t)) == [("2024-01", 2)]
    assert sum(r.num_customers for r in reports.churn_status(t, as_of="2024-02-01").collect()) == 2


def test_status_is_case_sensitive_and_null_is_not_completed(spark):
    t = tables(
        spark, customers=[(1, "A", "VIP")], products=[(1, "p", "Toys", 5)],
        orders=[(1, 1, "2024-01-05", "completed"), (2, 1, "2024-01-05", None)],
        items=[(1, 1, 2, 5.00), (2, 1, 1, 1)],
    )
    assert rows(reports.revenue_by_month(t)) == []


def test_churn_boundary(spark):
    t = tables(spark, orders=[
        (1, 1, "2024-01-01T06:00:00", DONE),   # exactly 90 days
        (2, 2, "2024-01-01T05:59:59", DONE),   # one second more
        (3, 3, "2020-01-01", DONE), (4, 3, "2020-01-02", DONE),
        (5, 4, "2020-01-01", "Cancelled"),
    ])
    assert rows(reports.churn_status(t, as_of="2024-03-31 06:00:00")) == [
        ("Churned", 1), ("New / Active (single order, recent)", 1), ("Repeat", 1),
    ]


def test_tier_boundaries(spark):
    spend = {1: [99.99], 2: [100], 3: [250, 250], 4: [200, 200.01, 50, 50], 5: [100] * 5}
    orders, items, k = [], [], 0
    for customer, amounts in spend.items():
        for amount in amounts:
            k += 1
            orders.append((k, customer, "2024-01-01T12:00:00", DONE))
            items.append((k, 1, 1, amount))
    t = tables(spark, customers=[(c, f"n{c}", "VIP") for c in spend],
               products=[(1, "p", "Toys", 5)], orders=orders, items=items)
    got = {r.customer_id: r for r in reports.segmentation(t, as_of="2024-01-03").collect()}
    assert [got[c].frequency_segment for c in spend] == [
        "One-time", "One-time", "Occasional", "Occasional", "Loyal",
    ]
    assert [got[c].spend_segment for c in spend] == ["Low", "Medium", "Medium", "High", "Medium"]
    assert {r.recency_days for r in got.values()} == {2.0}


def test_series_use_present_months(spark):
    t = tables(
        spark, orders=[(1, 1, "2024-01-05", DONE), (2, 1, "2024-03-05", DONE),
                       (3, 1, "2024-04-05", DONE), (4, 1, "2024-05-05", DONE)],
        items=[(1, 1, 1, 100), (2, 1, 1, 50), (3, 1, 1, 0), (4, 1, 1, 10)],
    )
    assert rows(reports.growth_rate(t)) == [
        ("2024-01", 100.0, None, None), ("2024-03", 50.0, 100.0, -50.0),
        ("2024-04", 0.0, 50.0, -100.0), ("2024-05", 10.0, 0.0, None),
    ]
    assert [r.moving_avg_3month for r in reports.moving_avg_revenue(t).collect()] == [
        100.0, 75.0, 50.0, 20.0,
    ]
    assert [r.running_total for r in reports.running_revenue(t).collect()] == [
        100.0, 150.0, 150.0, 160.0,
    ]


def test_ltv_ties(spark):
    t = tables(
        spark, customers=[(c, f"n{c}", "VIP") for c in range(1, 5)],
        orders=[(c, c, "2024-01-05", DONE) for c in range(1, 5)],
        items=[(1, 1, 1, 5), (2, 1, 1, 7), (3, 1, 1, 7), (4, 1, 1, 1)],
    )
    whole = rows(reports.top_customers_ltv(t).select("customer_id", "ltv_rank", "ltv_dense_rank"))
    assert whole == [(2, 1, 1), (3, 1, 1), (1, 3, 2), (4, 4, 3)]
    assert rows(
        reports.top_customers_ltv(t, limit=3).select("customer_id", "ltv_rank", "ltv_dense_rank")
    ) == whole[:3]


def test_retention_has_only_active_cells(spark):
    t = tables(spark, orders=[
        (1, 1, "2024-01-05", DONE), (2, 1, "2024-01-25", DONE), (3, 1, "2024-03-01", DONE),
        (4, 2, "2024-01-06", DONE), (5, 3, "2024-02-06", DONE), (6, 3, "2025-02-06", DONE),
    ])
    assert rows(reports.retention(t)) == [
        ("2024-01", 0, 2, 2, 100.0), ("2024-01", 2, 1, 2, 50.0),
        ("2024-02", 0, 1, 1, 100.0), ("2024-02", 12, 1, 1, 100.0),
    ]


# --- report access -----------------------------------------------------------


def test_access(spark, small, tmp_path):
    t = star_tables(spark, small)
    assert len(list_reports()) == 15
    by_default = run_report(t, "revenue_by_customer", completed=COMPLETED_STATUS)
    assert by_default.count() == 20
    assert run_report(t, "revenue_by_customer", 0, completed=COMPLETED_STATUS).count() > 20
    with pytest.raises(ValueError, match="revenue_by_month"):
        run_report(t, "revenue_by_moon")
    with pytest.raises(ValueError, match="negative"):
        run_report(t, "revenue_by_month", limit=-1)
    for fmt in ("parquet", "csv", "json"):
        save_report(by_default, f"{tmp_path}/{fmt}", fmt)
        saved = spark.read.format(fmt).option("header", True).load(f"{tmp_path}/{fmt}")
        assert saved.count() == 20


@pytest.mark.parametrize("name", list_reports())
def test_reports_on_empty_tables(spark, name):
    for limit in (0, 20):
        empty = run_report(tables(spark), name, limit=limit, as_of=AS_OF)
        assert empty.count() == 0 and len(empty.columns) >= 2


@pytest.mark.parametrize("name", list_reports())
def test_limit_is_a_prefix(spark, small, name):
    t = star_tables(spark, small)
    options = {"completed": COMPLETED_STATUS, "as_of": AS_OF}
    whole = rows(run_report(t, name, 0, **options))
    assert rows(run_report(t, name, 7, **options)) == whole[:7]


@pytest.mark.parametrize("split", [False, True])
def test_limits_with_and_without_slots(spark, small, split):
    t = star_tables(spark, small)
    for report in (reports.top_customers_ltv, reports.rank_within_customer):
        whole = rows(report(t, COMPLETED_STATUS))
        for limit in (5, 100):
            assert rows(report(t, COMPLETED_STATUS, limit=limit, split=split)) == whole[:limit]


# --- invariants --------------------------------------------------------------


def test_revenue_agrees_across_reports(spark, medium):
    t = star_tables(spark, medium)

    def total(report, column):
        return report(t, COMPLETED_STATUS).agg(F.sum(F.col(column).cast("decimal(38,2)"))).first()[0]

    by_month = total(reports.revenue_by_month, "total_revenue")
    assert by_month == total(reports.revenue_by_customer, "total_revenue")
    assert by_month == total(reports.revenue_by_category, "total_revenue")
    assert by_month == total(reports.top_products_revenue, "total_revenue")
    assert by_month == total(reports.rank_within_customer, "order_total")
    last = reports.running_revenue(t, COMPLETED_STATUS).collect()[-1]
    assert math.isclose(last.running_total, float(by_month), rel_tol=1e-15)


def test_people_agree_across_reports(spark, medium):
    t = star_tables(spark, medium)
    people = t.orders.filter(F.col("status") == COMPLETED_STATUS).select("customer_id")
    n = people.distinct().count()
    cohorts = reports.cohort_sizes(t, COMPLETED_STATUS)
    assert cohorts.agg(F.sum("customers_in_cohort")).first()[0] == n
    churn = reports.churn_status(t, COMPLETED_STATUS, as_of=AS_OF)
    assert churn.agg(F.sum("num_customers")).first()[0] == n
    start = reports.retention(t, COMPLETED_STATUS).filter("month_index = 0")
    assert {r.retention_pct for r in start.collect()} == {100.0}
    assert rows(start.select("cohort_month", "cohort_size")) == rows(cohorts)
