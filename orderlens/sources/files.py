"""Files in and out: raw delimited text, clean tables, reports, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.missing import na_to_null
from orderlens.functions.times import month_label, month_number, parse_timestamp
from orderlens.model import LOAD_ORDER, RAW_SCHEMAS, SCHEMAS, RawTables, Tables

# A quote inside a quoted field is doubled. Without `multiline`, files stay splittable
# and a field may hold commas and quotes but no line break.
_CSV = {"header": True, "quote": '"', "escape": '"'}


def read_raw_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """A raw table, its columns found by the names in the header.

    No-value tokens become null, and so does text that does not fit its column's type
    (`misfits` counts it); column types are declared, never inferred.  A missing or
    extra column is an error.
    """
    text = _read_text(spark, path, schema.fieldNames(), multiline)
    return text.select(*[_typed(f).alias(f.name) for f in schema])


def _read_text(spark: SparkSession, path: str, names: list[str], multiline: bool) -> DataFrame:
    """All columns as text. The first file's header gives their order, which the reader
    then asks of every file."""
    options = _CSV | {"multiLine": multiline}
    header = _load(lambda: spark.read.options(**options).csv(path), path).columns
    if sorted(header) != sorted(names):
        missing, extra = sorted(set(names) - set(header)), sorted(set(header) - set(names))
        raise ValueError(f"{path!r}: columns missing {missing}, columns not expected {extra}")
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return spark.read.options(**options, enforceSchema=False).schema(as_text).csv(path).select(*names)


def _typed(field: T.StructField) -> Column:
    text = na_to_null(F.col(field.name))
    if isinstance(field.dataType, T.IntegralType):
        # A column that once held a gap is written as 3.0, 4.0, ...
        number = text.try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number).try_cast(field.dataType)
    if isinstance(field.dataType, T.DateType):
        return parse_timestamp(text).cast("date")
    return text.try_cast(field.dataType)


def misfits(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """(column_name, misfits): texts per column that `read_raw_csv` turns into null.

    One aggregation over the file.  Columns that stay text have none.
    """
    text = _read_text(spark, path, schema.fieldNames(), multiline)
    counts = [
        F.count_if(na_to_null(F.col(f.name)).isNotNull() & _typed(f).isNull()).alias(f.name)
        for f in schema
    ]
    return text.agg(*counts).unpivot([], schema.fieldNames(), "column_name", "misfits")


def raw_misfits(
    spark: SparkSession, folder: str, suffix: str = ".csv", multiline: bool = False
) -> DataFrame:
    """(table_name, column_name, misfits) of the four raw files, for the cleaning log."""
    parts = [
        misfits(spark, f"{folder}/{name}{suffix}", RAW_SCHEMAS[name], multiline).select(
            F.lit(name).alias("table_name"), "column_name", "misfits"
        )
        for name in LOAD_ORDER
    ]
    return reduce(DataFrame.unionByName, parts)


def read_raw_tables(
    spark: SparkSession, folder: str, suffix: str = ".csv", multiline: bool = False
) -> RawTables:
    """`customers.csv`, `products.csv`, `orders.csv`, `order_items.csv` in a folder."""
    return RawTables(**{
        name: read_raw_csv(spark, f"{folder}/{name}{suffix}", RAW_SCHEMAS[name], multiline)
        for name in LOAD_ORDER
    })


def read_tables(
    spark: SparkSession, folder: str, fmt: str = "parquet", multiline: bool = False
) -> Tables:
    """Clean tables as `write_tables` left them."""

    def one(name: str) -> DataFrame:
        path = f"{folder}/{name}"
        if fmt == "csv":
            text = _read_text(spark, path, SCHEMAS[name].fieldNames(), multiline)
            return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in SCHEMAS[name]])
        return _load(lambda: spark.read.schema(SCHEMAS[name]).format(fmt).load(path), path)

    return Tables(**{name: one(name) for name in LOAD_ORDER})


def conform(df: DataFrame, table: str) -> DataFrame:
    """The columns of a clean table, by name and with their types."""
    return df.select(*[df[f.name].try_cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table or report; one file per task."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.options(**_CSV, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    writer.format(fmt).save(path)


def write_tables(tables, folder: str, fmt: str = "parquet") -> None:
    """Write all four tables, clean or raw, replacing what is there."""
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", fmt)


def write_orders_by_month(orders: DataFrame, path: str) -> None:
    """Orders in one folder per month, for queries that read a range of months.

    Rebalancing by month gives few files per folder, and adaptive execution splits
    a month that holds a large share of the orders into tasks of ordinary size.
    """
    month = month_label(month_number(F.col("order_date")))
    keyed = orders.withColumn("order_month", month)
    keyed.hint("rebalance", "order_month").write.mode("overwrite").partitionBy("order_month").parquet(path)


def write_counts(report: DataFrame, path: str) -> None:
    """The cleaning report as lines of JSON."""
    write_table(report, path, "json")


def _load(read, path: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        raise FileNotFoundError(
            f"no table at {path!r}; write the clean tables there first ({error})"
        ) from error
