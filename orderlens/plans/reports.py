"""The fifteen reports.

Each takes `Tables` and returns an ordered DataFrame.  `completed` names the
status that counts as a sale, `limit` keeps the first rows (0 keeps all), and
`as_of` replaces the wall clock wherever the age of an order matters.  Every sort
ends in a key, so a limit never cuts between equal rows at random.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.money import currency, rounded, sum_parts, total
from orderlens.functions.times import days_between, moment_literal, month_label, month_number
from orderlens.model import COMPLETED, Tables
from orderlens.operators import cutoff, ranking
from orderlens.plans import facts


def _ordered(df: DataFrame, limit: int, *order: Column | str) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered.limit(limit) if limit else ordered


def _now() -> datetime:
    """Current UTC time, for callers that do not fix `as_of`."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


# --- revenue -----------------------------------------------------------------


def revenue_by_customer(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Revenue and number of orders per customer, best first."""
    who = tables.customers.select("customer_id", "name", "segment")
    result = facts.customer_spend(tables, completed).join(who, "customer_id").select(
        "customer_id",
        "name",
        "segment",
        currency(F.col("spent")).alias("total_revenue"),
        F.col("orders").alias("total_orders"),
    )
    return _ordered(result, limit, F.desc("total_revenue"), "customer_id")


def revenue_by_category(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Revenue and units per product category, best first."""
    what = tables.products.select("product_id", "category")
    result = (
        facts.product_sales(tables, completed)
        .join(what, "product_id")
        .groupBy("category")
        .agg(
            *sum_parts(facts.AMOUNT),
            F.sum("units").alias("total_units_sold"),
        )
        .select("category", currency(total(facts.AMOUNT)).alias("total_revenue"), "total_units_sold")
    )
    return _ordered(result, limit, F.desc("total_revenue"), "category")


def revenue_by_month(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Revenue and number of orders per calendar month."""
    result = facts.monthly_revenue(tables, completed).select(
        month_label(F.col("month")).alias("order_month"),
        currency(F.col("month_amount")).alias("total_revenue"),
        F.col("orders").alias("total_orders"),
    )
    return _ordered(result, limit, "order_month")


def top_products_qty(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Products by units sold."""
    result = _with_product(tables, facts.product_sales(tables, completed)).select(
        "product_id", "product_name", "category", F.col("units").alias("total_units_sold")
    )
    return _ordered(result, limit, F.desc("total_units_sold"), "product_id")


def top_products_revenue(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Products by revenue."""
    result = _with_product(tables, facts.product_sales(tables, completed)).select(
        "product_id", "product_name", "category",
        currency(total(facts.AMOUNT)).alias("total_revenue"),
    )
    return _ordered(result, limit, F.desc("total_revenue"), "product_id")


def _with_product(tables: Tables, sales: DataFrame) -> DataFrame:
    return sales.join(
        tables.products.select("product_id", "product_name", "category"), "product_id"
    )


def aov_by_segment(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Mean order value per customer segment (mean of unrounded order totals).

    Orders without any price have no total and stay out of the mean; they count in
    `num_orders`.
    Sums and counts per customer are folded first, so the join to customers is
    one to one and a customer with very many orders is a single row.
    """
    who = tables.customers.select("customer_id", "segment")
    result = (
        facts.customer_spend(tables, completed)
        .join(who, "customer_id")
        .groupBy("segment")
        .agg(
            rounded(F.sum("spent").cast("double") / F.sum("priced_orders"), 2).alias(
                "avg_order_value"
            ),
            F.sum("orders").alias("num_orders"),
        )
    )
    return _ordered(result, limit, F.desc("avg_order_value"), "segment")


# --- ranks and series --------------------------------------------------------


def top_customers_ltv(
    tables: Tables, completed: str = COMPLETED, limit: int = 0, buckets: int | None = None,
    split: bool = False, few: int = cutoff.FEW_ROWS,
) -> DataFrame:
    """Customers ranked by lifetime value, with and without gaps after ties.

    With a limit the plan is a lazy top-n, which one task ranks; `split` is for limits
    too large for that: a cut-off is searched, and no task sees all rows above it (one
    sorts the last `few`).
    Without a limit, and with `split`, the ranking is cut into value slots (`buckets`, by
    default by size).  Both run jobs while the plan is built.
    """
    who = tables.customers.select("customer_id", "name")
    spend = (
        facts.customer_spend(tables, completed)
        .join(who, "customer_id")
        # Ranked by the value shown: customers whose values round alike tie.
        .select("customer_id", "name", F.round("spent", 2).alias("spent"))
    )
    names = ("spent", "customer_id", "ltv_rank", "ltv_dense_rank")
    if limit and not split:
        ranked = ranking.rank_top(spend, *names, n=limit)
    else:
        if limit:
            # Ranks depend on rows above alone.
            order = [("spent", True), ("customer_id", False)]
            spend = cutoff.first_rows(spend, limit, order, few=few, slots=buckets or cutoff.SLOTS)
        ranked = ranking.rank_all(spend, *names, buckets=buckets)
    result = ranked.select(
        "customer_id",
        "name",
        currency(F.col("spent")).alias("lifetime_value"),
        "ltv_rank",
        "ltv_dense_rank",
    )
    # With `split` the rows are those within the limit already.
    return _ordered(result, 0 if split else limit, "ltv_rank", "customer_id")


# The three series below use windows without a partition key. Their input is one
# row per calendar month, which no amount of data makes large.


def running_revenue(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Monthly revenue and its running total."""
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    result = facts.monthly_revenue(tables, completed).select(
        month_label(F.col("month")).alias("order_month"),
        currency(F.col("month_amount")).alias("monthly_total"),
        currency(F.sum("month_amount").over(so_far)).alias("running_total"),
    )
    return _ordered(result, limit, "order_month")


def moving_avg_revenue(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Monthly revenue and its mean over this and the two preceding present months."""
    last_three = Window.orderBy("month").rowsBetween(-2, 0)
    summed, months = F.sum("month_amount").over(last_three), F.count("month_amount").over(last_three)
    mean = summed.cast("double") / months
    result = facts.monthly_revenue(tables, completed).select(
        month_label(F.col("month")).alias("order_month"),
        currency(F.col("month_amount")).alias("monthly_total"),
        rounded(mean, 2).alias("moving_avg_3month"),
    )
    return _ordered(result, limit, "order_month")


def growth_rate(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Change against the previous present month, in percent; null where there is
    no previous month or it had no revenue."""
    previous = F.lag("month_amount").over(Window.orderBy("month"))
    step = facts.monthly_revenue(tables, completed).withColumn("previous", previous)
    change = (F.col("month_amount") - F.col("previous")).cast("double")
    base = F.col("previous").cast("double")
    result = step.select(
        month_label(F.col("month")).alias("order_month"),
        currency(F.col("month_amount")).alias("monthly_total"),
        currency(F.col("previous")).alias("prev_month_total"),
        F.when(F.col("previous") != 0, rounded(F.lit(100.0) * change / base, 2)).alias(
            "growth_rate_pct"
        ),
    )
    return _ordered(result, limit, "order_month")


def rank_within_customer(
    tables: Tables, completed: str = COMPLETED, limit: int = 0,
    hot_rows: int = ranking.HOT_ROWS, buckets: int | None = None, split: bool = False,
) -> DataFrame:
    """Every order ranked by its total among the orders of the same customer.

    With a limit the plan is lazy and no customer brings more than `limit` orders to a
    task; `split` is for limits too large for that.  Without a limit, and with `split`,
    a job over orders alone looks for customers with more than `hot_rows` orders; those
    are ranked in slots instead of in one task.
    """
    totals = facts.order_totals(tables, completed)
    names = ("customer_id", "order_amount", "order_id", "rank_within_customer")
    if limit and not split:
        ranked = ranking.first_by_group(totals, *names, n=limit)
    else:
        sizes = (
            facts.completed_orders(tables, completed)
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        ranked = ranking.rank_within(
            totals, *names, group_sizes=sizes, hot_rows=hot_rows, buckets=buckets
        )
    result = ranked.select(
        "customer_id",
        "order_id",
        "order_date",
        currency(F.col("order_amount")).alias("order_total"),
        "rank_within_customer",
    )
    return _ordered(result, limit, "customer_id", "rank_within_customer", "order_id")


# --- cohorts and segments ----------------------------------------------------


def cohort_sizes(tables: Tables, completed: str = COMPLETED, limit: int = 0) -> DataFrame:
    """Customers per month of first completed order."""
    result = (
        facts.completed_orders(tables, completed)
        .groupBy("customer_id")
        .agg(F.min(month_number(F.col("order_date"))).alias("cohort"))
        .groupBy("cohort")
        .agg(F.count(F.lit(1)).alias("customers_in_cohort"))
        .select(month_label(F.col("cohort")).alias("cohort_month"), "customers_in_cohort")
    )
    return _ordered(result, limit, "cohort_month")


def retention(
    tables: Tables, completed: str = COMPLETED, limit: int = 0, most_words: int = facts.MOST_WORDS
) -> DataFrame:
    """Share of each cohort active n months after its first month, for the months
    in which anyone was.

    Runs a job that looks for the first and last month (`facts.cohort_activity`).  The
    cohort size is its count at index 0, where every member is active by definition.
    """
    cells = facts.cohort_activity(tables, completed, most_words)
    at_start = F.when(F.col("month_index") == 0, F.col("active_customers"))
    cell = F.struct("month_index", "active_customers")
    sized = (
        cells.groupBy("cohort")
        .agg(F.max(at_start).alias("cohort_size"), F.collect_list(cell).alias("cells"))
        .select("cohort", "cohort_size", F.inline("cells"))
    )
    result = sized.select(
        month_label(F.col("cohort")).alias("cohort_month"),
        "month_index",
        "active_customers",
        "cohort_size",
        rounded(F.lit(100.0) * F.col("active_customers") / F.col("cohort_size"), 1).alias(
            "retention_pct"
        ),
    )
    return _ordered(result, limit, "cohort_month", "month_index")


# The labels that reports print.
REPEAT, CHURNED, ACTIVE = "Repeat", "Churned", "New / Active (single order, recent)"
ONE_TIME, OCCASIONAL, LOYAL = "One-time", "Occasional", "Loyal"
LOW, MEDIUM, HIGH = "Low", "Medium", "High"


def churn_status(
    tables: Tables, completed: str = COMPLETED, limit: int = 0,
    as_of: datetime | str | None = None, churn_days: float = 90.0,
) -> DataFrame:
    """Customers that came back, that bought once long ago, and that bought once lately."""
    age = days_between(moment_literal(as_of or _now()), F.col("last_order_date"))
    status = (
        F.when(F.col("orders") > 1, REPEAT).when(age > churn_days, CHURNED).otherwise(ACTIVE)
    )
    result = (
        facts.completed_orders(tables, completed)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("orders"), F.max("order_date").alias("last_order_date"))
        .groupBy(status.alias("customer_status"))
        .agg(F.count(F.lit(1)).alias("num_customers"))
    )
    return _ordered(result, limit, "customer_status")


def segmentation(
    tables: Tables, completed: str = COMPLETED, limit: int = 0,
    as_of: datetime | str | None = None,
    occasional: tuple[int, int] = (2, 4), medium: tuple[float, float] = (100, 500),
) -> DataFrame:
    """Frequency, spend and recency per customer with a tier for the first two.

    `occasional` and `medium` are the inclusive bounds of the middle tiers.
    """
    age = days_between(moment_literal(as_of or _now()), F.col("last_order_date"))
    who = tables.customers.select("customer_id", "name")
    frequency, monetary = F.col("orders"), currency(F.col("spent"))
    frequency_tier = (
        F.when(frequency < occasional[0], ONE_TIME)
        .when(frequency.between(*occasional), OCCASIONAL)
        .otherwise(LOYAL)
    )
    spend_tier = (
        F.when(monetary < medium[0], LOW).when(monetary.between(*medium), MEDIUM).otherwise(HIGH)
    )
    result = facts.customer_spend(tables, completed).join(who, "customer_id").select(
        "customer_id",
        "name",
        frequency.alias("frequency"),
        monetary.alias("monetary"),
        rounded(age, 0).alias("recency_days"),
        frequency_tier.alias("frequency_segment"),
        spend_tier.alias("spend_segment"),
    )
    return _ordered(result, limit, F.desc("monetary"), "customer_id")
