"""Exact-row deduplication with counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.durable import Scratch

#: Row hashes (two numbers each) that are broadcast; with more of them every row is shuffled.
BROADCAST_HASHES = 1_000_000

_HASHES = ("_hash_a", "_hash_b")


def collapse_copies(df: DataFrame, count_column: str = "copies") -> DataFrame:
    """One row per distinct row, with the number of copies; null equals null.

    The map-side half of the aggregation folds copies before the shuffle, so a
    row repeated in a third of the table reaches the reducer once per map task.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count_column))


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of a row as two numbers. Equal rows (null equals null) have equal hashes."""
    # Which columns are null goes in as well, since a hash skips nulls.
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])
    return F.xxhash64(nulls, *columns), F.xxhash64(F.lit(1), *columns, nulls)


def collapse_rare_copies(
    df: DataFrame, held: Scratch, count_column: str = "copies",
    hashes: Callable[[Sequence[str]], tuple[Column, Column]] = row_hashes,
    most: int = BROADCAST_HASHES,
) -> DataFrame:
    """`collapse_copies` for tables in which few rows have copies: the others never move.

    A job shuffles a hash and a count of each row and stores the hashes that occur more
    than once.  Rows with any other hash have no copy and stay where they are; those few
    are compared in full, so different rows with equal hashes stay different.  With more
    than `most` such hashes every row is shuffled, as in `collapse_copies`.

    `df` is read three times, its hashes once, so it must give the same rows each time.
    The stored hashes must live as long as the result is used.
    """
    named = dict(zip(_HASHES, hashes(df.columns)))
    counted = df.select(*[c.alias(name) for name, c in named.items()]).groupBy(*_HASHES)
    repeated, n = held.counted(counted.agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*_HASHES))
    if n > most:
        return collapse_copies(df, count_column)
    marked, few = df.withColumns(named), F.broadcast(repeated)
    alone = marked.join(few, list(_HASHES), "left_anti").select(
        *df.columns, F.lit(1).cast("bigint").alias(count_column)
    )
    others = marked.join(few, list(_HASHES), "left_semi").select(*df.columns)
    return alone.unionByName(collapse_copies(others, count_column))


def surplus_copies(df: DataFrame) -> DataFrame:
    """One row: how many rows exact deduplication would remove."""
    return collapse_copies(df).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicates")
    )
