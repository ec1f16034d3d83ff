"""Fault injection: corrupt clean tables at known rates to exercise cleaning.

Each injector changes the rows where a boolean column holds.  Build that column
with `operators.sampling.share` (a rate) or `every` (a modulus); both depend on
keys alone, so reruns and retried tasks corrupt the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.sampling import sample_rows, share

# Fixed value: the text that stands for an unreadable date.
NOT_A_DATE = "not_a_date"


@dataclass(frozen=True)
class Rates:
    """Share of rows hit by each fault, and numbers of duplicated rows."""

    # The usual rates and counts.
    missing_email: float = 0.05
    missing_phone: float = 0.04
    noisy_name: float = 0.03
    upper_email: float = 0.02
    missing_category: float = 0.04
    negative_price: float = 0.02
    zero_price: float = 0.02
    unknown_customer: float = 0.02
    unparseable_date: float = 0.015
    future_date: float = 0.015
    blank_date: float = 0.01
    unknown_product: float = 0.015
    unknown_order: float = 0.01
    negative_quantity: float = 0.015
    missing_price: float = 0.01
    duplicate_customers: int = 15
    duplicate_orders: int = 20
    duplicate_items: int = 25


RATES = Rates()


def null_out(df: DataFrame, column: str, hit: Column) -> DataFrame:
    return df.withColumn(column, F.when(~hit, F.col(column)))


def pad_and_shout(df: DataFrame, column: str, hit: Column) -> DataFrame:
    """Upper case with two blanks on both sides."""
    noisy = F.concat(F.lit("  "), F.upper(F.col(column)), F.lit("  "))
    return df.withColumn(column, F.when(hit, noisy).otherwise(F.col(column)))


def shout(df: DataFrame, column: str, hit: Column) -> DataFrame:
    return df.withColumn(column, F.when(hit, F.upper(F.col(column))).otherwise(F.col(column)))


def negate(df: DataFrame, column: str, hit: Column) -> DataFrame:
    return df.withColumn(column, F.when(hit, -F.col(column)).otherwise(F.col(column)))


def zero(df: DataFrame, column: str, hit: Column) -> DataFrame:
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(hit, F.lit(0).cast(kind)).otherwise(F.col(column)))


def shift_key(df: DataFrame, column: str, hit: Column, offset: int) -> DataFrame:
    """Point a reference at a key beyond the real ones."""
    return df.withColumn(column, F.when(hit, F.col(column) + offset).otherwise(F.col(column)))


def break_dates(
    df: DataFrame, column: str, unparseable: Column, blank: Column, future: Column,
    future_text: str,
) -> DataFrame:
    """Dates as text, some unreadable, blank or far ahead; the first hit wins."""
    text = F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss")
    broken = (
        F.when(unparseable, NOT_A_DATE).when(blank, "").when(future, future_text).otherwise(text)
    )
    return df.withColumn(column, broken)


def duplicate_sample(df: DataFrame, n: int, key: Column, seed: str) -> DataFrame:
    """Append exact copies of `n` sampled rows."""
    return df.unionByName(sample_rows(df, n, key, seed))


def dirty_customers(df: DataFrame, rates: Rates = RATES) -> DataFrame:
    key = F.col("customer_id")
    return duplicate_sample(
        noisy_case(missing_contacts(df, rates), rates), rates.duplicate_customers, key, "copy"
    )


def missing_contacts(df: DataFrame, rates: Rates = RATES) -> DataFrame:
    key = F.col("customer_id")
    without_email = null_out(df, "email", share(key, rates.missing_email, "email"))
    return null_out(without_email, "phone", share(key, rates.missing_phone, "phone"))


def noisy_case(df: DataFrame, rates: Rates = RATES) -> DataFrame:
    key = F.col("customer_id")
    noisy = pad_and_shout(df, "name", share(key, rates.noisy_name, "name"))
    return shout(noisy, "email", share(key, rates.upper_email, "shout"))


def dirty_products(df: DataFrame, rates: Rates = RATES) -> DataFrame:
    key = F.col("product_id")
    return bad_prices(null_out(df, "category", share(key, rates.missing_category, "category")),
                      rates)


def bad_prices(df: DataFrame, rates: Rates = RATES) -> DataFrame:
    key = F.col("product_id")
    below = negate(df, "price", share(key, rates.negative_price, "negative"))
    return zero(below, "price", share(key, rates.zero_price, "zero"))


def dirty_orders(df: DataFrame, future_text: str, rates: Rates = RATES) -> DataFrame:
    key = F.col("order_id")
    return duplicate_sample(
        bad_dates(unknown_customers(df, rates), future_text, rates),
        rates.duplicate_orders, key, "copy",
    )


def unknown_customers(df: DataFrame, rates: Rates = RATES, offset: int = 10**12) -> DataFrame:
    return shift_key(
        df, "customer_id", share(F.col("order_id"), rates.unknown_customer, "customer"), offset
    )


def bad_dates(df: DataFrame, future_text: str, rates: Rates = RATES) -> DataFrame:
    key = F.col("order_id")
    return break_dates(
        df, "order_date",
        unparseable=share(key, rates.unparseable_date, "unparseable"),
        blank=share(key, rates.blank_date, "blank"),
        future=share(key, rates.future_date, "future"),
        future_text=future_text,
    )


def dirty_order_items(df: DataFrame, key: Column, rates: Rates = RATES) -> DataFrame:
    """`key` identifies a line; any column or expression that does will do."""
    broken = bad_lines(unknown_parents(df, key, rates), key, rates)
    return duplicate_sample(broken, rates.duplicate_items, key, "copy")


def unknown_parents(
    df: DataFrame, key: Column, rates: Rates = RATES, offset: int = 10**12
) -> DataFrame:
    # Both choices are made before either key moves, should `key` be built on them.
    chosen = df.withColumns({
        "_product": share(key, rates.unknown_product, "product"),
        "_order": share(key, rates.unknown_order, "order"),
    })
    shifted = shift_key(chosen, "product_id", F.col("_product"), offset)
    return shift_key(shifted, "order_id", F.col("_order"), offset).drop("_product", "_order")


def bad_lines(df: DataFrame, key: Column, rates: Rates = RATES) -> DataFrame:
    chosen = df.withColumns({
        "_quantity": share(key, rates.negative_quantity, "quantity"),
        "_price": share(key, rates.missing_price, "price"),
    })
    negative = negate(chosen, "quantity", F.col("_quantity"))
    return null_out(negative, "unit_price", F.col("_price")).drop("_quantity", "_price")
