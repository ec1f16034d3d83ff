"""Bounded picks that no single task has to sort a whole table for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 20


def hash_place(*columns: str | Column) -> Column:
    """The first bits of a hash, 0 to _STEPS - 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 44)


def least_hashes(df: DataFrame, n: int, *columns: str | Column) -> DataFrame:
    """At most `n` rows of `df`: those with the least hashes of `columns`.

    A count comes first, and rows whose hash is far too large for one of the `n` least
    are dropped where they are, so what is gathered follows `n`, not the table.  Equal
    rows are equally likely to be taken; the pick is the same in every run.
    """
    total = df.count()
    place = hash_place(*columns)
    if total > 2 * n:
        # Half as many again as needed: fewer than n are left with next to no chance.
        df = df.filter(place < int(1.5 * n / total * _STEPS) + 64)
    return df.orderBy(place, F.xxhash64(*columns), *columns).limit(n)


def most_frequent(counts: DataFrame, n: int, count: str, tie: str) -> DataFrame:
    """The `n` rows with the greatest `count`, ties by `tie`.

    Counts of counts, in steps of a few percent, show which rows can't be among them;
    those are dropped where they are.
    """
    step = F.floor(F.log2(F.col(count).cast("double")) * 32).cast("int")
    sizes = {r.step: r.rows for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    seen, least = 0, None
    for at in sorted(sizes, reverse=True):
        seen, least = seen + sizes[at], at
        if seen >= n:
            break
    kept = counts if least is None else counts.filter(step >= least)
    return kept.orderBy(F.desc(count), tie).limit(n)
