"""The four retail tables: column types, keys, constraints and containers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Six decimals: a price below a cent is stored and summed as it is.
MONEY_DIGITS = 6
MONEY = T.DecimalType(20, MONEY_DIGITS)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("segment", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", MONEY),
])

# Order time is a local wall-clock reading without a zone, hence TIMESTAMP_NTZ:
# months and day differences then never depend on the session time zone.
ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_item_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
])

SCHEMAS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
}


def _raw(schema: T.StructType, **changed: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, changed.get(f.name, f.dataType)) for f in schema
    ])


# Before cleaning, dates are free text and prices are whatever was typed.
RAW_SCHEMAS = {
    "customers": CUSTOMERS,
    "products": _raw(PRODUCTS, price=T.DoubleType()),
    "orders": _raw(ORDERS, order_date=T.StringType()),
    "order_items": _raw(ORDER_ITEMS, unit_price=T.DoubleType()),
}

# Constraints the stored tables promise; `plans.integrity` turns each into a query.
PRIMARY_KEYS = {
    "customers": ("customer_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_item_id",),
}

REQUIRED_COLUMNS = {
    "customers": ("name", "email", "signup_date", "segment"),
    "products": ("product_name", "category", "price"),
    "orders": ("customer_id", "order_date", "status"),
    "order_items": ("order_id", "product_id", "quantity", "unit_price"),
}

POSITIVE_COLUMNS = {
    "products": ("price",),
    "order_items": ("quantity", "unit_price"),
}

# (child table, child column, parent table); the parent column has the same name.
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
)

# Parents precede children: the order in which tables are cleaned and loaded.
LOAD_ORDER = ("customers", "products", "orders", "order_items")

COMPLETED = "Completed"


class _FourTables:
    """Each table is a DataFrame, or a function that returns one on first use, so
    that a report opens only the tables it reads."""

    def __init__(self, customers, products, orders, order_items):
        self._tables = dict(zip(LOAD_ORDER, (customers, products, orders, order_items)))

    def __getitem__(self, name: str) -> DataFrame:
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def items(self):
        """(name, DataFrame) pairs, parents first."""
        return [(name, self[name]) for name in LOAD_ORDER]

    @property
    def customers(self) -> DataFrame:
        return self["customers"]

    @property
    def products(self) -> DataFrame:
        return self["products"]

    @property
    def orders(self) -> DataFrame:
        return self["orders"]

    @property
    def order_items(self) -> DataFrame:
        return self["order_items"]


class Tables(_FourTables):
    """Typed tables, ready for reports."""


class RawTables(_FourTables):
    """Tables as received: text dates, unchecked keys, possible duplicates."""
