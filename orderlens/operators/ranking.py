"""RANK and DENSE_RANK, descending, without a single-task window.

A window sends each of its partitions to one task.  That is fatal for a rank
over the whole table, and for a group that holds a large share of it.  Here such
a group is cut into *slots* along the ranked value:

* boundaries come from an approximate-percentile sketch (at most `buckets - 1`);
* values strictly between two boundaries share an even slot, values equal to a
  boundary an odd slot of their own, so equal values never part;
* rank = rows in higher slots + rank inside the slot.

An odd slot holds one value, every row of which has inner rank 1; it is therefore
salted freely, and a value shared by a third of all rows is no hot spot either.
Boundaries only steer the balance; any boundaries give the exact ranks, as long
as every pass uses the same ones, which is why they are fixed first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.operators.durable import durable

#: Rows that one slot is meant to hold; a table gets as many slots as that takes.
SLOT_ROWS = 2_000_000
HOT_ROWS = 5_000_000
#: Slot offsets (a few numbers each) that are broadcast; more are joined by a shuffle.
BROADCAST_OFFSETS = 100_000


def slots_for(rows: int) -> int:
    return max(2, -(-rows // SLOT_ROWS))


def rank_all(
    df: DataFrame, value: str, tie: str, rank: str, dense_rank: str,
    buckets: int | None = None,
) -> DataFrame:
    """Rank the whole table by `value`, highest first. `tie` spreads equal values.

    Runs three jobs: one writes `df` (three passes follow), one counts it unless
    `buckets` says how many slots there are, one finds boundaries.
    """
    rows = durable(df)
    buckets = buckets or slots_for(rows.count())
    sketch = rows.agg(_boundaries(value, buckets).alias("cuts")).first()
    cuts = _literals(sketch.cuts or [], df.schema[value].dataType.simpleString())
    slotted = _with_slot(rows, value, cuts, buckets)
    offsets = _offsets(slotted, [], value)
    # At most 2 * buckets - 1 rows. The left join keeps Spark from testing every slot
    # for null with a second binary search.
    few = 2 * buckets <= BROADCAST_OFFSETS
    placed = slotted.join(F.broadcast(offsets) if few else offsets, "_slot", "left")
    return _finish(placed, [], value, tie, rank, dense_rank, buckets)


def rank_top(
    df: DataFrame, value: str, tie: str, rank: str, dense_rank: str, n: int
) -> DataFrame:
    """The first `n` rows of the ranking. Ranks depend only on rows above, so the
    top-n is taken first (n candidates per task) and only those rows are ranked."""
    top = df.orderBy(F.desc(value), F.asc(tie)).limit(n)
    order = Window.orderBy(F.desc(value))
    return top.withColumn(rank, F.rank().over(order).cast("bigint")).withColumn(
        dense_rank, F.dense_rank().over(order).cast("bigint")
    )


def rank_within(
    df: DataFrame, group: str, value: str, tie: str, rank: str,
    group_sizes: DataFrame | None = None, hot_rows: int = HOT_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """Rank inside each group, highest first.

    `group_sizes` (group, rows) may overstate sizes and lets the caller derive
    them from something cheaper than `df`.  Runs one job to look for groups above
    `hot_rows`.  All other groups get the plain partitioned window.  The null group is
    a group like any other.
    """
    if group_sizes is None:
        group_sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))
    # A struct is never null and compares null fields as equal, so joins on it take the
    # null group along.
    keyed = F.struct(F.col(group).alias("key"))
    # At most (all rows / hot_rows) keys.
    hot = durable(
        group_sizes.filter(F.col("rows") > hot_rows).select(keyed.alias("_group"), "rows")
    )
    largest = hot.agg(F.max("rows")).first()[0]
    if largest is None:
        return _plain_rank(df, group, value, rank)
    buckets = buckets or slots_for(largest)
    hot = hot.select("_group")

    rows = durable(df.withColumn("_group", keyed))
    ordinary = _plain_rank(rows.join(hot, "_group", "left_anti"), "_group", value, rank)
    crowded = rows.join(hot, "_group", "left_semi")
    cuts = durable(crowded.groupBy("_group").agg(_boundaries(value, buckets).alias("_cuts")))
    # Written out, so that the passes below start from plain files and not from a
    # join that has already gathered each group in one place.
    slotted = durable(
        _with_slot(crowded.join(cuts, "_group"), value, F.col("_cuts"), buckets).drop("_cuts")
    )
    placed = slotted.join(_offsets(slotted, ["_group"], value), ["_group", "_slot"], "left")
    split = _finish(placed, ["_group"], value, tie, rank, None, buckets)
    return ordinary.unionByName(split).drop("_group")


def _plain_rank(df: DataFrame, group: str, value: str, rank: str) -> DataFrame:
    window = Window.partitionBy(group).orderBy(F.desc(value))
    return df.withColumn(rank, F.rank().over(window).cast("bigint"))


def first_by_group(
    df: DataFrame, group: str, value: str, tie: str, rank: str, n: int
) -> DataFrame:
    """A part of `rank_within` that holds its first `n` rows by group, rank and tie.

    No group can contribute more than its own first n rows.  For a small n Spark
    applies that row-number bound before the shuffle too, so a hot group arrives
    trimmed.
    """
    ordered = Window.partitionBy(group).orderBy(F.desc(value), F.asc(tie))
    leading = df.withColumn("_row", F.row_number().over(ordered)).filter(F.col("_row") <= n)
    by_value = Window.partitionBy(group).orderBy(F.desc(value))
    return leading.withColumn(rank, F.rank().over(by_value).cast("bigint")).drop("_row")


def _boundaries(value: str, buckets: int) -> Column:
    shares = _literals([i / buckets for i in range(1, buckets)], "double")
    # Off by at most a quarter of a bucket; a finer sketch would be larger to merge.
    sketch = F.call_function("percentile_approx", F.col(value), shares, F.lit(4 * buckets))
    return F.array_sort(F.array_distinct(sketch))


def _literals(values: list, kind: str) -> Column:
    """A constant array. As one text literal it costs the optimizer a single node."""
    text = F.split(F.lit(",".join(map(str, values))), ",") if values else F.array()
    return text.cast(f"array<{kind}>")


def _with_slot(df: DataFrame, value: str, cuts: Column, buckets: int) -> DataFrame:
    """Slot = 2 * (boundaries below the value), plus 1 if it is a boundary itself.

    Binary search in the sorted array, largest step first; a step past the end
    reads null and is not taken.
    """
    steps = F.array(*[F.lit(1 << p) for p in range(buckets.bit_length(), -1, -1)])
    wanted = F.col(value)
    below = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) < wanted, at + step).otherwise(at),
    )
    equal = F.coalesce(F.get(cuts, F.col("_below")) == wanted, F.lit(False))
    return (
        df.withColumn("_below", below)
        .withColumn("_slot", F.col("_below") * 2 + equal.cast("int"))
        .drop("_below")
    )


def _offsets(slotted: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Rows and distinct values above each slot; pre-aggregated by value."""
    per_slot = (
        slotted.groupBy(*groups, "_slot", value)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(*groups, "_slot")
        .agg(F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    )
    above = (
        Window.partitionBy(*groups)
        .orderBy(F.desc("_slot"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return per_slot.select(
        *groups,
        "_slot",
        F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_rows_above"),
        F.coalesce(F.sum("_values").over(above), F.lit(0)).alias("_values_above"),
    )


def _finish(
    placed: DataFrame, groups: list[str], value: str, tie: str,
    rank: str, dense_rank: str | None, buckets: int,
) -> DataFrame:
    single_value = F.col("_slot") % 2 == 1
    salt = F.when(single_value, F.pmod(F.xxhash64(tie), F.lit(buckets))).otherwise(0)
    inner = Window.partitionBy(*groups, "_slot", "_salt").orderBy(F.desc(value))
    rows_above = F.coalesce("_rows_above", F.lit(0))
    # The explicit shuffle matters where `placed` is already partitioned by a part
    # of the key: Spark would accept that and leave the salt without effect.
    spread = placed.withColumn("_salt", salt).repartition(*groups, "_slot", "_salt")
    result = spread.withColumn(rank, (rows_above + F.rank().over(inner)).cast("bigint"))
    if dense_rank is not None:
        values_above = F.coalesce("_values_above", F.lit(0))
        result = result.withColumn(
            dense_rank, (values_above + F.dense_rank().over(inner)).cast("bigint")
        )
    return result.drop("_slot", "_salt", "_rows_above", "_values_above")
