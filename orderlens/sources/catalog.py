"""Catalog tables: create, replace, append, read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from orderlens.model import LOAD_ORDER, SCHEMAS, Tables
from orderlens.plans.integrity import require_integrity
from orderlens.sources.files import conform

# Bucketing orders and their lines by order_id on both sides stores the shuffle
# that nearly every revenue query starts with.
BUCKET_COLUMNS = {"orders": "order_id", "order_items": "order_id"}


def _name(database: str | None, table: str) -> str:
    return f"{database}.{table}" if database else table


def create_tables(spark: SparkSession, database: str | None = None, buckets: int = 0) -> None:
    """Drop and create the four empty tables, children dropped first."""
    for table in reversed(LOAD_ORDER):
        spark.sql(f"DROP TABLE IF EXISTS {_name(database, table)}")
    for table in LOAD_ORDER:
        _save(spark.createDataFrame([], SCHEMAS[table]), table, database, buckets, "overwrite")


def append_tables(
    tables: Tables, database: str | None = None, buckets: int = 0, verify: bool = True
) -> None:
    """Add rows, parents first.

    With `verify`, a repeated key (among the new rows or with a stored one), a null, a
    value that is not positive or a reference that neither stored nor new rows resolve
    stops the load before anything is written.  Of the stored rows only keys are read.
    """
    if verify:
        stored = load_tables(tables.customers.sparkSession, database)
        require_integrity(tables, stored=stored)
    for table in LOAD_ORDER:
        _save(conform(tables[table], table), table, database, buckets, "append")


def replace_tables(
    tables: Tables, database: str | None = None, buckets: int = 0, verify: bool = True
) -> None:
    """Full replace. With `verify`, a broken key, constraint or reference stops
    the load before anything is written."""
    if verify:
        require_integrity(tables)
    for table in LOAD_ORDER:
        _save(conform(tables[table], table), table, database, buckets, "overwrite")


def load_tables(spark: SparkSession, database: str | None = None) -> Tables:
    def one(table: str) -> DataFrame:
        try:
            return spark.table(_name(database, table))
        except AnalysisException as error:
            raise LookupError(
                f"table {_name(database, table)!r} is missing; load the tables first ({error})"
            ) from error

    return Tables(**{table: one(table) for table in LOAD_ORDER})


def _save(df: DataFrame, table: str, database: str | None, buckets: int, mode: str) -> None:
    writer = df.write.format("parquet").mode(mode)
    if buckets and table in BUCKET_COLUMNS:
        column = BUCKET_COLUMNS[table]
        writer = writer.bucketBy(buckets, column).sortBy(column)
    writer.saveAsTable(_name(database, table))
