"""Shared intermediate tables behind the reports.

Order lines are by far the largest table, so they are folded to one row per order
(or per product) as early as possible.  `order_id` is the key of orders, hence
"distinct orders" is a plain row count after that step.  Orders without lines
drop out of everything built on `order_totals`, and stay in what reads
`completed_orders` alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.money import part_names, sum_parts, total, with_line_parts
from orderlens.functions.times import month_number
from orderlens.model import COMPLETED, Tables
from orderlens.operators import keysets
from orderlens.operators.durable import Scratch

#: The amount whose parts (`money.part_names`) folds carry.
AMOUNT = "amount"

#: Months in one word of a bitmap, and the words (30 years) up to which bitmaps are kept.
WORD_MONTHS = 60
MOST_WORDS = 6

#: Share of completed orders up to which lines are tested before they are folded.
FEW_COMPLETED = 0.5


def completed_orders(tables: Tables, completed: str = COMPLETED) -> DataFrame:
    """Orders that count; the status test is pushed into the scan."""
    return tables.orders.filter(F.col("status") == completed).select(
        "order_id", "customer_id", "order_date"
    )


def lines_of_completed(
    tables: Tables, held: Scratch, completed: str = COMPLETED, most: float = FEW_COMPLETED
) -> Tables:
    """`tables` whose order lines are, but for a few, those of completed orders.

    For reports on orders with that status, whose results stay the same: the lines of
    other orders go where they are read, by a broadcast key filter, instead of being
    folded, shuffled and dropped by the join.  Runs a job that counts orders; if more
    than the share `most` of them is completed, or the filter would need more than its
    greatest size, `tables` are returned as they are, and lines are folded first.
    Otherwise a second job writes the filter, which must live as long as the result.
    """
    done = F.col("status") == completed
    counted = tables.orders.agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(done & F.col("order_id").isNotNull()).alias("done")
    ).first()
    blocks = keysets.filter_blocks(counted.done)
    too_many = blocks * keysets.BLOCK_BITS < 2 * counted.done
    if counted.done > most * counted.orders or too_many:
        return tables
    found = held.store(keysets.key_filter(completed_orders(tables, completed), "order_id", blocks))
    lines = keysets.maybe_known(tables.order_items, "order_id", found, blocks)
    return Tables(lambda: tables.customers, lambda: tables.products, lambda: tables.orders, lines)


def _order_parts(tables: Tables, completed: str) -> DataFrame:
    """order_id, customer_id, order_date and the parts of the amount of completed orders with lines.

    Lines are summed per order before the join: the shuffle carries one partial
    sum per order and map task however many lines an order has, and the join,
    which is one to one, reuses that shuffle.
    """
    lines = with_line_parts(tables.order_items.select("order_id", "quantity", "unit_price"), AMOUNT)
    per_order = lines.groupBy("order_id").agg(*sum_parts(AMOUNT))
    return completed_orders(tables, completed).join(per_order, "order_id")


def order_totals(tables: Tables, completed: str = COMPLETED) -> DataFrame:
    """order_id, customer_id, order_date, order_amount for completed orders with lines."""
    return _order_parts(tables, completed).select(
        "order_id", "customer_id", "order_date", total(AMOUNT).alias("order_amount")
    )


def customer_spend(tables: Tables, completed: str = COMPLETED) -> DataFrame:
    """customer_id, spent, orders, priced_orders, last_order_date.

    An order none of whose lines has a price counts as an order, but has no total.
    """
    return (
        _order_parts(tables, completed)
        .groupBy("customer_id")
        .agg(
            *sum_parts(AMOUNT),
            F.count(F.lit(1)).alias("orders"),
            F.count(part_names(AMOUNT)[0]).alias("priced_orders"),
            F.max("order_date").alias("last_order_date"),
        )
        .select(
            "customer_id", total(AMOUNT).alias("spent"), "orders", "priced_orders", "last_order_date"
        )
    )


def product_sales(tables: Tables, completed: str = COMPLETED) -> DataFrame:
    """product_id, units and the parts of the amount, for lines of completed orders.

    The semi join needs only order keys.  A hot order is split by adaptive
    execution (its lines are the large side, the key side has one row); a hot
    product is folded map-side before the shuffle on product_id.
    """
    wanted = completed_orders(tables, completed).select("order_id")
    lines = tables.order_items.join(wanted, "order_id", "left_semi")
    priced = with_line_parts(lines.select("product_id", "quantity", "unit_price"), AMOUNT)
    return priced.groupBy("product_id").agg(
        *sum_parts(AMOUNT), F.sum(F.col("quantity").cast("bigint")).alias("units")
    )


def monthly_revenue(tables: Tables, completed: str = COMPLETED) -> DataFrame:
    """month (number), month_amount, orders: one row per month that has revenue."""
    return (
        _order_parts(tables, completed)
        .groupBy(month_number(F.col("order_date")).alias("month"))
        .agg(*sum_parts(AMOUNT), F.count(F.lit(1)).alias("orders"))
        .select("month", total(AMOUNT).alias("month_amount"), "orders")
    )


def customer_months(tables: Tables, completed: str = COMPLETED) -> DataFrame:
    """Distinct (customer_id, month) in which the customer had a completed order."""
    return (
        completed_orders(tables, completed)
        .select("customer_id", month_number(F.col("order_date")).alias("month"))
        .distinct()
    )


def month_span(tables: Tables, completed: str = COMPLETED) -> tuple[int, int] | None:
    """First and last month with a completed order, None if there is none. Runs a job."""
    dates = completed_orders(tables, completed).agg(
        month_number(F.min("order_date")).alias("first"), month_number(F.max("order_date")).alias("last")
    ).first()
    return None if dates.first is None else (dates.first, dates.last)


def customer_activity(
    tables: Tables, span: tuple[int, int], completed: str = COMPLETED
) -> DataFrame:
    """customer_id, dateless, word_0, word_1, ...: months with a completed order as bitmaps.

    Bit i of word w is the month `WORD_MONTHS * w + i` after the first of `span`, which must
    hold all months; `dateless` says that some order has no date.  One shuffle, of a few
    BIGINTs per customer and map task, however many orders or months a customer has.
    """
    after = month_number(F.col("order_date")) - span[0]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("after") % WORD_MONTHS)
    word = F.floor(F.col("after") / WORD_MONTHS)
    return (
        completed_orders(tables, completed)
        .select("customer_id", after.alias("after"))
        .groupBy("customer_id")
        .agg(F.max(F.col("after").isNull()).alias("dateless"), *[
            F.coalesce(F.bit_or(F.when(word == w, bit)), F.lit(0).cast("bigint")).alias(f"word_{w}")
            for w in range(_words(span))
        ])
    )


def _words(span: tuple[int, int]) -> int:
    return (span[1] - span[0]) // WORD_MONTHS + 1


def cohort_activity(
    tables: Tables, completed: str = COMPLETED, most_words: int = MOST_WORDS
) -> DataFrame:
    """cohort, month_index, active_customers: customers by first month and months since then.

    Runs a job that looks for the first and last month.  The cells are counted from one
    row of bitmaps per customer; if the months span more than `most_words` words, which
    takes a date far off, from distinct (customer, month) rows.
    """
    span = month_span(tables, completed)
    if span is None or _words(span) > most_words:
        by_customer = Window.partitionBy("customer_id")
        months = customer_months(tables, completed).withColumn("cohort", F.min("month").over(by_customer))
    else:
        months = _months_of_bitmaps(customer_activity(tables, span, completed), span)
    return months.groupBy("cohort", (F.col("month") - F.col("cohort")).alias("month_index")).agg(
        F.count(F.lit(1)).alias("active_customers")
    )


def _months_of_bitmaps(activity: DataFrame, span: tuple[int, int]) -> DataFrame:
    """(cohort, month), a row per customer and month, in the task that has the customer.

    The months of the span are an array constant, which generated code steps through and
    filters; a null stands for orders without a date.
    """
    words = [F.col(f"word_{w}") for w in range(_words(span))]
    # The lowest bit that is set: as many bits lie below it.
    starts = [
        F.when(word != 0, F.bit_count(word.bitwiseAND(-word) - 1) + span[0] + w * WORD_MONTHS)
        for w, word in enumerate(words)
    ]
    steps = F.array(*[F.lit(i) for i in range(span[1] - span[0] + 1)], F.lit(None).cast("int"))
    at = F.col("at")
    chosen = F.coalesce(*[F.when(at < (w + 1) * WORD_MONTHS, word) for w, word in enumerate(words)])
    active = F.when(at.isNull(), F.col("dateless")).otherwise(F.getbit(chosen, at % WORD_MONTHS) == 1)
    return (
        activity.withColumn("cohort", F.coalesce(*starts))
        .withColumn("at", F.explode(steps))
        .filter(active)
        .select("cohort", (at + span[0]).alias("month"))
    )
