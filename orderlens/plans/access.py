"""Run a report by name."""

from __future__ import annotations

import inspect
from datetime import datetime

from pyspark.sql import DataFrame

from orderlens.model import COMPLETED, Tables
from orderlens.plans import reports

REPORTS = {
    function.__name__: function
    for function in (
        reports.revenue_by_customer,
        reports.revenue_by_category,
        reports.revenue_by_month,
        reports.top_products_qty,
        reports.top_products_revenue,
        reports.aov_by_segment,
        reports.top_customers_ltv,
        reports.running_revenue,
        reports.moving_avg_revenue,
        reports.growth_rate,
        reports.rank_within_customer,
        reports.cohort_sizes,
        reports.retention,
        reports.churn_status,
        reports.segmentation,
    )
}

DEFAULT_LIMIT = 20


def list_reports() -> list[str]:
    return list(REPORTS)


def run_report(
    tables: Tables, name: str, limit: int = DEFAULT_LIMIT,
    as_of: datetime | str | None = None, completed: str = COMPLETED, **options,
) -> DataFrame:
    """The named report as a DataFrame; `limit=0` keeps all rows.

    The limit is part of the plan, so Spark never computes rows it will not show
    where it can avoid it.  An empty result is an empty DataFrame.
    """
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; available: {', '.join(REPORTS)}")
    if limit < 0:
        raise ValueError("limit cannot be negative")
    report = REPORTS[name]
    if "as_of" in inspect.signature(report).parameters:
        options["as_of"] = as_of
    return report(tables, completed=completed, limit=limit, **options)


def save_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a whole report; rows go from the tasks to files, not to the driver."""
    from orderlens.sources.files import write_table

    write_table(report, path, fmt)
