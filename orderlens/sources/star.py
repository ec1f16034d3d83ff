"""The retail tables as views over a TPC-H-like star schema in parquet.

Columns a report does not use are never read: each view is a projection that
Spark prunes down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.model import RawTables, Tables
from orderlens.operators.sampling import every, repeat_rows
from orderlens.plans import faults

# The status of a delivered order, and a fixed "now" just after the last order.
COMPLETED_STATUS = "F"
AS_OF = "2001-09-01 06:00:00"

# The line table has no unique line id; this pair is the nearest thing to a key.
KEYS = {
    "customers": ("customer_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "line_number"),
}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def star_tables(spark: SparkSession, folder: str) -> Tables:
    """Clean tables. Contact columns exist only in `raw_star_tables`."""
    return Tables(
        lambda: _customers(spark, folder),
        lambda: _products(spark, folder),
        lambda: _orders(spark, folder),
        lambda: _lines(spark, folder),
    )


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    # The extended price serves as unit price; it stays DOUBLE as stored, since
    # amounts are computed in cents either way.
    return _read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )


def contact_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with every column of the model; contacts are derived from the key."""
    customer = _read(spark, folder, "customer")
    nation = _read(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city")
    )
    key = F.col("c_custkey")
    return customer.join(nation, "c_nationkey", "left").select(
        key.alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("user"), key, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("555-"), key).alias("phone"),
        "city",
        F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(key, F.lit(900)).cast("int")).alias(
            "signup_date"
        ),
        F.col("c_mktsegment").alias("segment"),
    )


def raw_star_tables(spark: SparkSession, folder: str) -> RawTables:
    """The same tables with faults at fixed key moduli, for cleaning and checks."""
    return RawTables(
        lambda: _raw_customers(contact_customers(spark, folder)),
        lambda: _raw_products(_products(spark, folder)),
        lambda: _raw_orders(_orders(spark, folder)),
        lambda: _raw_lines(_lines(spark, folder)),
    )


def _raw_customers(df: DataFrame) -> DataFrame:
    key, name = F.col("customer_id"), F.col("name")
    odd_name = F.concat(F.lit("  o'neil MCDONALD-smith "), key)
    padded = F.concat(F.lit("  "), F.upper(name), F.lit("  "))
    renamed = df.withColumn(
        "name",
        F.when(every(key, 101), None)
        .when(every(key, 37), odd_name)
        .when(every(key, 33), padded)
        .otherwise(name),
    )
    shouting = faults.shout(renamed, "email", every(key, 50, 1))
    without_email = faults.null_out(shouting, "email", every(key, 20))
    without_phone = faults.null_out(without_email, "phone", every(key, 25))
    return repeat_rows(without_phone, every(key, 53))


def _raw_products(df: DataFrame) -> DataFrame:
    key = F.col("product_id")
    without_category = faults.null_out(df, "category", every(key, 25))
    negative = faults.negate(without_category, "price", every(key, 40, 1))
    return faults.zero(negative, "price", every(key, 40, 2))


def _raw_orders(df: DataFrame) -> DataFrame:
    key = F.col("order_id")
    lost = faults.shift_key(df, "customer_id", every(key, 50), 1_000_000)
    dated = faults.break_dates(
        lost, "order_date",
        unparseable=every(key, 67), blank=every(key, 97), future=every(key, 71),
        future_text="2031-05-06 00:00:00",
    )
    return repeat_rows(dated, every(key, 199))


def _raw_lines(df: DataFrame) -> DataFrame:
    order, line, product = F.col("order_id"), F.col("line_number"), F.col("product_id")
    # All hits are decided on the original keys, before any of them moves.
    chosen = df.withColumns({
        "_order": every(product, 101),
        "_product": every(order + line, 67),
        "_quantity": every(order + F.col("supplier_id"), 61),
        "_price": every(order + product, 103),
        "_copy": every(order + product, 499),
    })
    broken = faults.shift_key(chosen, "order_id", F.col("_order"), 10_000_000)
    broken = faults.shift_key(broken, "product_id", F.col("_product"), 1_000_000)
    broken = faults.negate(broken, "quantity", F.col("_quantity"))
    broken = faults.null_out(broken, "unit_price", F.col("_price"))
    doubled = repeat_rows(broken, F.col("_copy"))
    return doubled.drop("_order", "_product", "_quantity", "_price", "_copy")
