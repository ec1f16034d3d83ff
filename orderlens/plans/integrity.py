"""Keys, constraints and references as queries.

Spark tables have no enforced constraints, so each promise of the model becomes
a DataFrame of its violations.  `require_integrity` turns them into an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.model import FOREIGN_KEYS, POSITIVE_COLUMNS, PRIMARY_KEYS, REQUIRED_COLUMNS
from orderlens.operators.keysets import orphan_count


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def pk_violations(tables, keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS) -> DataFrame:
    """Key values that repeat or are null: table_name, key_value, copies.

    A composite key is shown as its parts joined by `/`, a null part as `null`.
    """

    def broken(table: str, columns: Sequence[str]) -> DataFrame:
        text = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
        has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
        return (
            tables[table]
            .groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("copies"))
            .filter((F.col("copies") > 1) | has_null)
            .select(F.lit(table).alias("table_name"), F.concat_ws("/", *text).alias("key_value"),
                    "copies")
        )

    return _stack([broken(table, columns) for table, columns in keys.items()])


def not_null_violations(
    tables, required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS
) -> DataFrame:
    """Nulls per required column, one aggregation per table."""
    return _per_column(tables, required, lambda c: F.col(c).isNull())


def check_violations(
    tables, positive: Mapping[str, Sequence[str]] = POSITIVE_COLUMNS
) -> DataFrame:
    """Values that are not above zero; like a CHECK, a null is not a violation."""
    return _per_column(tables, positive, lambda c: F.col(c) <= 0)


def _per_column(tables, columns, broken) -> DataFrame:
    def counted(table: str, names: Sequence[str]) -> DataFrame:
        wide = tables[table].agg(*[F.count_if(broken(c)).alias(c) for c in names])
        return wide.withColumn("table_name", F.lit(table)).unpivot(
            ["table_name"], list(names), "column_name", "violations"
        )

    return _stack([counted(table, names) for table, names in columns.items()])


def fk_violations(tables, foreign_keys=FOREIGN_KEYS) -> DataFrame:
    """References without a parent; a null reference is allowed here."""
    return _stack([
        orphan_count(tables[child], column, tables[parent], null_is_orphan=False).select(
            F.lit(child).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(parent).alias("parent_table"),
            F.col("orphans").alias("violations"),
        )
        for child, column, parent in foreign_keys
    ])


def table_counts(tables) -> DataFrame:
    return _stack([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ])


def orphan_orders(tables) -> DataFrame:
    """Orders without a customer; a null customer is an orphan."""
    return _orphans(tables, "orders", "customer_id", "customers", "orphan_orders")


def orphan_items_order(tables) -> DataFrame:
    """Order lines without an order."""
    return _orphans(tables, "order_items", "order_id", "orders", "orphan_items_order")


def orphan_items_product(tables) -> DataFrame:
    """Order lines without a product."""
    return _orphans(tables, "order_items", "product_id", "products", "orphan_items_product")


def _orphans(tables, child: str, column: str, parent: str, name: str) -> DataFrame:
    return orphan_count(tables[child], column, tables[parent]).withColumnRenamed("orphans", name)


def integrity_verdict(tables) -> DataFrame:
    """One row: the three orphan counts and whether all are zero."""
    checks = (orphan_orders, orphan_items_order, orphan_items_product)
    names = [check.__name__ for check in checks]
    # Three one-row frames side by side: each fills its own column of a union.
    rows = _stack([
        check(tables).select(*[
            F.col(n) if n == check.__name__ else F.lit(0).cast("bigint").alias(n) for n in names
        ])
        for check in checks
    ])
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return rows.agg(*[F.sum(n).alias(n) for n in names]).withColumn(
        "integrity_ok", total == 0
    )


def clashing_keys(tables, stored, keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS) -> DataFrame:
    """Rows whose key is stored already: table_name, clashes."""
    return _stack([
        tables[table].select(*columns).join(stored[table].select(*columns), list(columns), "left_semi")
        .agg(F.count(F.lit(1)).alias("clashes"))
        .select(F.lit(table).alias("table_name"), "clashes")
        for table, columns in keys.items()
    ])


def missing_parents(tables, stored, foreign_keys=FOREIGN_KEYS) -> DataFrame:
    """References that neither new nor stored rows resolve; as `fk_violations`."""
    parents = {
        (parent, column): tables[parent].select(column).unionByName(stored[parent].select(column))
        for _, column, parent in foreign_keys
    }
    return _stack([
        orphan_count(tables[child], column, parents[parent, column], null_is_orphan=False).select(
            F.lit(child).alias("table_name"), F.lit(column).alias("column_name"),
            F.lit(parent).alias("parent_table"), F.col("orphans").alias("violations"),
        )
        for child, column, parent in foreign_keys
    ])


def require_integrity(
    tables, keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS, stored=None
) -> None:
    """Raise ValueError naming every broken promise. Runs jobs; fetches only counts.

    With `stored` tables, `tables` are rows to be added to them.
    """
    references = fk_violations(tables) if stored is None else missing_parents(tables, stored)
    problems = [] if stored is None else [
        f"{r.table_name}: {r.clashes} keys that are stored already"
        for r in clashing_keys(tables, stored, keys).filter("clashes > 0").collect()
    ]
    problems += [
        f"{r.table_name}: {r.n} key values repeated or null"
        for r in pk_violations(tables, keys)
        .groupBy("table_name").agg(F.count(F.lit(1)).alias("n")).collect()
    ]
    for frame, what in (
        (not_null_violations(tables), "nulls in {0.column_name}"),
        (check_violations(tables), "values of {0.column_name} not above zero"),
        (references, "values of {0.column_name} missing in {0.parent_table}"),
    ):
        problems += [
            f"{r.table_name}: {r.violations} {what.format(r)}"
            for r in frame.filter("violations > 0").collect()
        ]
    if problems:
        raise ValueError("integrity check failed: " + "; ".join(sorted(problems)))
