"""Small hand-made tables."""

from datetime import datetime

from orderlens.model import RAW_SCHEMAS, SCHEMAS, RawTables, Tables


def moment(text):
    return datetime.fromisoformat(text)


def tables(spark, customers=(), products=(), orders=(), items=()):
    """customers (id, name, segment); products (id, name, category, price);
    orders (id, customer, date, status); items (order, product, quantity, price)."""
    from decimal import Decimal

    rows = {
        "customers": [(i, n, "e", "p", "c", moment("2020-01-01").date(), s)
                      for i, n, s in customers],
        "products": [(i, n, c, Decimal(str(p))) for i, n, c, p in products],
        "orders": [(i, c, moment(d), s) for i, c, d, s in orders],
        "order_items": [(k, o, p, q, None if u is None else Decimal(str(u)))
                        for k, (o, p, q, u) in enumerate(items)],
    }
    return Tables(**{n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()})


def raw(spark, table, rows):
    return spark.createDataFrame(rows, RAW_SCHEMAS[table])


def raw_tables(spark, customers=(), products=(), orders=(), items=()):
    return RawTables(
        raw(spark, "customers", list(customers)), raw(spark, "products", list(products)),
        raw(spark, "orders", list(orders)), raw(spark, "order_items", list(items)),
    )


def rows(df):
    return [tuple(r) for r in df.collect()]
