"""Cleaning with exact accounting.

Every table goes through one pass that yields a *judged* frame: one row per
distinct input row, the repaired columns, `copies` (how often the row occurred)
and `violation` (the first rule it breaks, null if none).  The clean table and
the counts are two views of that frame, so they cannot disagree:

    rows in = rows out + surplus copies + rows per violation

Judges that are given a `Scratch` take it that few rows have copies and few keys are
unknown: small jobs find those first, and no row of the table is shuffled but the copies.
Without one they are lazy: one scan, and a shuffle for the copies and for each key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.missing import fill, nan_to_null
from orderlens.functions.money import stored_price
from orderlens.functions.text import strip_blanks, title_case
from orderlens.functions.times import DATE_FORMATS, cut_to_second, moment_literal, parse_timestamp
from orderlens.model import LOAD_ORDER, RawTables, Tables
from orderlens.operators.dedup import collapse_copies, collapse_rare_copies
from orderlens.operators.durable import Scratch, durable, observed, scratch
from orderlens.operators.keysets import flag_known, flag_known_but_few

# What stands in for a missing entry.
UNKNOWN_NAME = "Unknown"
UNKNOWN_CONTACT = "unknown"
NO_CATEGORY = "Uncategorized"

_BOOKKEEPING = ("copies", "violation")


def first_violation(*rules: tuple[str, Column]) -> Column:
    """Label of the first rule whose condition holds; a row is counted only there."""
    verdict = F.lit(None).cast("string")
    for label, broken in reversed(rules):
        verdict = F.when(broken, label).otherwise(verdict)
    return verdict


# --- judged frames -----------------------------------------------------------


def _folded(rows: DataFrame, held: Scratch | None) -> DataFrame:
    return collapse_copies(rows) if held is None else collapse_rare_copies(rows, held)


def _flagged(rows: DataFrame, column: str, keys: DataFrame, flag: str, held: Scratch | None) -> DataFrame:
    if held is None:
        return flag_known(rows, column, keys, flag)
    return flag_known_but_few(rows, column, keys, flag, held)


def judge_customers(raw: DataFrame, held: Scratch | None = None) -> DataFrame:
    """Repair names and contacts, then fold rows that became identical."""
    repaired = raw.withColumns({
        "name": title_case(strip_blanks(fill(F.col("name"), UNKNOWN_NAME))),
        "email": F.lower(strip_blanks(fill(F.col("email"), UNKNOWN_CONTACT))),
        "phone": fill(F.col("phone"), UNKNOWN_CONTACT),
    })
    return _folded(repaired, held).withColumn("violation", F.lit(None).cast("string"))


def judge_products(raw: DataFrame) -> DataFrame:
    """Fill categories and refuse prices that are not positive. Copies stay.

    Rules look at the price as it will be stored, so no accepted row breaks them later.
    """
    price, unstorable = _price(F.col("price"))
    return raw.withColumns({
        "category_filled": F.col("category").isNull(),
        "category": fill(F.col("category"), NO_CATEGORY),
        "price": price,
        "copies": F.lit(1).cast("bigint"),
        "violation": first_violation(
            ("price_out_of_range", unstorable), ("missing_price", price.isNull()), ("bad_price", price <= 0)
        ),
    })


def _price(raw: Column) -> tuple[Column, Column]:
    """The price as it is stored, and whether there is one that can't be stored:
    infinite or too large. NaN is a missing price."""
    number = nan_to_null(raw.cast("double"))
    stored = stored_price(number)
    return stored, number.isNotNull() & stored.isNull()


def judge_orders(
    raw: DataFrame, customers: DataFrame, as_of: datetime | str,
    formats: Sequence[str] = DATE_FORMATS, held: Scratch | None = None,
) -> DataFrame:
    """Fold copies (raw text compared), then check date and customer."""
    rows = _flagged(_folded(raw, held), "customer_id", customers, "known_customer", held)
    flagged = rows.withColumn("order_date", parse_timestamp(F.col("order_date"), formats))
    return (
        flagged.withColumn(
            "violation",
            first_violation(
                ("unparseable_date", F.col("order_date").isNull()),
                ("future_date", F.col("order_date") > moment_literal(as_of)),
                ("unknown_customer", ~F.col("known_customer")),
            ),
        )
        .withColumn("order_date", cut_to_second(F.col("order_date")))
        .select(*raw.columns, *_BOOKKEEPING)
    )


def judge_order_items(
    raw: DataFrame, orders: DataFrame, products: DataFrame, held: Scratch | None = None
) -> DataFrame:
    """Fold copies, then check order, product, quantity and price.

    `orders` and `products` are the accepted ones: a refused order or product
    takes its lines along.
    """
    rows = _flagged(_folded(raw, held), "order_id", orders, "known_order", held)
    flagged = _flagged(rows, "product_id", products, "known_product", held)
    price, unstorable = _price(F.col("unit_price"))
    return (
        flagged.withColumn(
            "violation",
            first_violation(
                ("unknown_order", ~F.col("known_order")),
                ("unknown_product", ~F.col("known_product")),
                ("bad_quantity", F.col("quantity") <= 0),
                ("missing_quantity", F.col("quantity").isNull()),
                ("price_out_of_range", unstorable),
                ("missing_price", price.isNull()),
            ),
        )
        .withColumn("unit_price", price)
        .select(*raw.columns, *_BOOKKEEPING)
    )


def accepted(judged: DataFrame) -> DataFrame:
    """The clean table of a judged frame."""
    extra = [c for c in (*_BOOKKEEPING, "category_filled", "refused") if c in judged.columns]
    # Where the rows are stored apart, only the accepted ones are read.
    clean = judged.filter(~F.col("refused")) if "refused" in judged.columns else judged
    return clean.filter(F.col("violation").isNull()).drop(*extra)


def accepted_order_keys(
    raw_orders: DataFrame, customers: DataFrame, as_of: datetime | str,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Keys of the orders that cleaning keeps, for checking order lines.

    The same rules as `judge_orders`, but membership does not care about copies
    and nothing is counted: no deduplication, and a semi join instead of a flag.
    """
    # An unreadable date is null, and a null is not up to `as_of` either.
    in_time = parse_timestamp(F.col("order_date"), formats) <= moment_literal(as_of)
    dated = raw_orders.filter(in_time).select("order_id", "customer_id")
    return dated.join(customers.select("customer_id"), "customer_id", "left_semi").select("order_id")


# --- one call per table ------------------------------------------------------


def clean_customers(raw: RawTables) -> DataFrame:
    return accepted(judge_customers(raw.customers))


def clean_products(raw: RawTables) -> DataFrame:
    return accepted(judge_products(raw.products))


def clean_orders(
    raw: RawTables, as_of: datetime | str, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    return accepted(judge_orders(raw.orders, raw.customers, as_of, formats))


def clean_order_items(
    raw: RawTables, as_of: datetime | str, formats: Sequence[str] = DATE_FORMATS,
    held: Scratch | None = None,
) -> DataFrame:
    """Clean order lines; with `held`, jobs look for copies and unknown keys first."""
    orders = accepted_order_keys(raw.orders, raw.customers, as_of, formats)
    return accepted(judge_order_items(raw.order_items, orders, clean_products(raw), held))


# --- accounting --------------------------------------------------------------


def _count_violation(label: str) -> Column:
    return F.count_if(F.col("violation") == label)


def _kept() -> Column:
    return F.col("violation").isNull()


def _raw_rows() -> Column:
    return F.coalesce(F.sum("copies"), F.lit(0))


def _surplus() -> Column:
    return F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))


def _customer_metrics() -> dict[str, Column]:
    return {
        "raw_rows": _raw_rows(),
        "duplicates_removed": _surplus(),
        # As filled or as typed: a literal "unknown" counts, too.
        "emails_filled": F.count_if(F.col("email") == UNKNOWN_CONTACT),
        "phones_filled": F.count_if(F.col("phone") == UNKNOWN_CONTACT),
        "cleaned_rows": F.count_if(_kept()),
    }


def _product_metrics() -> dict[str, Column]:
    return {
        "raw_rows": _raw_rows(),
        "categories_filled": F.count_if("category_filled"),
        "bad_prices_removed": _count_violation("bad_price"),
        "missing_prices_removed": _count_violation("missing_price"),
        "prices_out_of_range_removed": _count_violation("price_out_of_range"),
        "cleaned_rows": F.count_if(_kept()),
    }


def _order_metrics() -> dict[str, Column]:
    return {
        "raw_rows": _raw_rows(),
        "duplicates_removed": _surplus(),
        "unparseable_dates_removed": _count_violation("unparseable_date"),
        "future_dates_removed": _count_violation("future_date"),
        "unknown_customers_removed": _count_violation("unknown_customer"),
        "cleaned_rows": F.count_if(_kept()),
    }


def _order_item_metrics() -> dict[str, Column]:
    return {
        "raw_rows": _raw_rows(),
        "duplicates_removed": _surplus(),
        "unknown_orders_removed": _count_violation("unknown_order"),
        "unknown_products_removed": _count_violation("unknown_product"),
        "bad_quantities_removed": _count_violation("bad_quantity"),
        "missing_quantities_removed": _count_violation("missing_quantity"),
        "missing_prices_removed": _count_violation("missing_price"),
        "prices_out_of_range_removed": _count_violation("price_out_of_range"),
        "cleaned_rows": F.count_if(_kept()),
    }


_METRICS = {
    "customers": _customer_metrics, "products": _product_metrics, "orders": _order_metrics,
    "order_items": _order_item_metrics,
}


def customer_counts(judged: DataFrame) -> DataFrame:
    return _counts("customers", judged)


def product_counts(judged: DataFrame) -> DataFrame:
    return _counts("products", judged)


def order_counts(judged: DataFrame) -> DataFrame:
    return _counts("orders", judged)


def order_item_counts(judged: DataFrame) -> DataFrame:
    return _counts("order_items", judged)


def _counts(table: str, judged: DataFrame) -> DataFrame:
    """All counts of one table in one aggregation, as (table_name, metric, value)."""
    metrics = _METRICS[table]()
    wide = judged.agg(*[c.cast("bigint").alias(name) for name, c in metrics.items()])
    return wide.withColumn("table_name", F.lit(table)).unpivot(
        ["table_name"], list(metrics), "metric", "value"
    )


def _report(spark: SparkSession, found: dict[str, dict[str, int]]) -> DataFrame:
    rows = [(table, metric, value) for table, counts in found.items() for metric, value in counts.items()]
    return spark.createDataFrame(rows, "table_name string, metric string, value bigint")


def cleaning_report(
    raw: RawTables, as_of: datetime | str, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Every count of every table.

    Runs a job per table, which reads it once and counts while it hands on nothing
    but the keys that order lines are checked against; no row is written.  Customers,
    products and orders (which need bare customer keys alone) are judged side by side.
    """
    found: dict[str, dict[str, int]] = {}

    def counted(name: str, judged: DataFrame, hand_on: Callable[[DataFrame], DataFrame | None]):
        seen, counts = observed(judged, _METRICS[name]())
        handed = hand_on(seen)
        found[name] = counts()
        return handed

    def nothing(seen: DataFrame) -> None:
        seen.select("violation").write.format("noop").mode("overwrite").save()

    with scratch() as held, ThreadPoolExecutor(3) as jobs:

        def keys(name: str, judged: DataFrame, key: str) -> DataFrame:
            return counted(name, judged, lambda seen: held.store(accepted(seen).select(key)))

        waiting = [
            jobs.submit(inheritable_thread_target(raw.orders.sparkSession)(work), *given)
            for work, *given in (
                (keys, "orders", judge_orders(raw.orders, raw.customers, as_of, formats), "order_id"),
                (keys, "products", judge_products(raw.products), "product_id"),
                (counted, "customers", judge_customers(raw.customers), nothing),
            )
        ]
        orders, products, _ = [job.result() for job in waiting]
        counted("order_items", judge_order_items(raw.order_items, orders, products), nothing)
    return _report(raw.orders.sparkSession, {name: found[name] for name in LOAD_ORDER})


# --- whole run ---------------------------------------------------------------


@dataclass(frozen=True)
class Cleaned:
    tables: Tables
    report: DataFrame


def clean_all(
    raw: RawTables, as_of: datetime | str, formats: Sequence[str] = DATE_FORMATS,
    folder: str | None = None,
) -> Cleaned:
    """Clean all four tables, parents first.

    Each judged frame is written once, and the job that writes it takes its counts; the
    clean table and the key checks of its children read that copy.  Before that, small
    jobs look for rows with copies and for unknown keys, so that few rows are shuffled.

    With `folder` that copy is the result: `<folder>/<table>/refused=false` holds the
    clean rows, `refused=true` the others with the rule they break, and nothing needs
    to be written a second time.  Otherwise the copies go when the application ends.
    """
    found = {}
    with scratch() as held:

        def kept(name: str, judged: DataFrame) -> DataFrame:
            if folder is None:
                seen, counts = observed(judged, _METRICS[name]())
                result = durable(seen)
            else:
                path = f"{folder}/{name}"
                split = judged.withColumn("refused", F.col("violation").isNotNull())
                seen, counts = observed(split, _METRICS[name]())
                seen.write.mode("overwrite").partitionBy("refused").parquet(path)
                result = judged.sparkSession.read.schema(split.schema).parquet(path)
            found[name] = counts()
            return result

        customers = kept("customers", judge_customers(raw.customers, held))
        products = kept("products", judge_products(raw.products))
        orders = kept(
            "orders", judge_orders(raw.orders, accepted(customers), as_of, formats, held)
        )
        items = kept(
            "order_items",
            judge_order_items(raw.order_items, accepted(orders), accepted(products), held),
        )
    tables = Tables(accepted(customers), accepted(products), accepted(orders), accepted(items))
    return Cleaned(tables, _report(raw.orders.sparkSession, found))
