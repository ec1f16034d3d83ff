"""Key-to-value lookup with a default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame, key: str, table: DataFrame, value: str, target: str, default: Column
) -> DataFrame:
    """Add `target`: the table's value for the key, or `default` if it has none.

    Keys of `table` are unique (`plans.integrity.pk_violations` tells).  A key that
    holds a large share of `df` is split by adaptive execution.
    """
    found = "_found_value"
    pairs = table.select(F.col(key), F.col(value).alias(found))
    joined = df.join(pairs, key, "left")
    return joined.withColumn(target, F.coalesce(F.col(found), default)).drop(found)
