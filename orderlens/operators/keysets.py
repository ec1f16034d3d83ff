"""Membership of a column in the key set of another table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.durable import Scratch

#: Unknown key values that are broadcast; with more of them rows are joined to all keys.
BROADCAST_KEYS = 1_000_000


def flag_known(df: DataFrame, column: str, keys: DataFrame, flag: str) -> DataFrame:
    """Add a boolean: does `column` occur among the keys? A null never does.

    A left join to the distinct keys, so that known and unknown rows stay in one
    pass.  The join has no hint: Spark broadcasts a key set it has measured to be
    small, and otherwise sort-merges, where adaptive execution splits a key that
    holds a large share of `df` (the key side has one row per key).

    It only does so if both inputs come straight from a shuffle made for the join.
    The second, derived grouping column sees to that: without it Spark would reuse
    the partitioning of the distinct and give up the split.  The price is one more
    shuffle of bare keys.
    """
    part = F.xxhash64(column).alias("_part")
    marked = keys.select(column).groupBy(column, part).agg(F.lit(True).alias(flag)).drop("_part")
    return df.join(marked, column, "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def flag_known_but_few(
    df: DataFrame, column: str, keys: DataFrame, flag: str, held: Scratch,
    most: int = BROADCAST_KEYS,
) -> DataFrame:
    """`flag_known` where few values are unknown: no row of `df` moves.

    A job finds and stores the values of `column` that are not among the keys, from bare
    distinct values; rows are then tested against those.  With more than `most` of them
    the rows are joined to the keys, as in `flag_known`.  The stored values must live as
    long as the result is used.
    """
    wanted = df.select(column).filter(F.col(column).isNotNull()).distinct()
    missing, n = held.counted(wanted.join(keys.select(column).distinct(), column, "left_anti"))
    if n > most:
        return flag_known(df, column, keys, flag)
    absent = F.broadcast(missing.withColumn("_absent", F.lit(True)))
    marked = df.join(absent, column, "left")
    return marked.withColumn(flag, F.col(column).isNotNull() & F.col("_absent").isNull()).drop("_absent")


def orphan_count(
    child: DataFrame, column: str, parent: DataFrame, null_is_orphan: bool = True
) -> DataFrame:
    """One row `orphans`: child rows whose key the parent does not have.

    Children are counted per key before the anti join, so the join sees each key
    once per side and a hot key costs no more than a rare one.
    """
    per_key = child.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    if not null_is_orphan:
        per_key = per_key.filter(F.col(column).isNotNull())
    missing = per_key.join(parent.select(column), column, "left_anti")
    return missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphans"))


#: Bits of a key filter per key, and in all: 32 MB, the most that is broadcast for one.
BITS_PER_KEY = 8
MOST_BITS = 2**28
BLOCK_BITS = 2**15
_WORDS = BLOCK_BITS // 64


def filter_blocks(keys: int) -> int:
    """Blocks of 32,768 bits that a filter of so many keys gets; a power of two."""
    most = MOST_BITS // BLOCK_BITS
    return min(most, 1 << max(0, (keys * BITS_PER_KEY - 1) // BLOCK_BITS).bit_length())


def key_filter(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """A Bloom filter of the values of `column`: rows (block, words), 512 BIGINT words each.

    A key sets two bits of one block, which its hash chooses.  Bits are merged by
    `bit_or` in each task before they are shuffled, so the filter's size, not that of
    the keys, is what moves.  Nulls set nothing.
    """
    block, first, second = _places(F.col(column), blocks)
    bits = keys.filter(F.col(column).isNotNull()).select(
        block.alias("block"), F.explode(F.array(first, second)).alias("bit")
    )
    words = bits.select(
        "block", F.shiftright("bit", 6).alias("word"),
        F.expr("shiftleft(1L, bit % 64)").alias("bits"),
    )
    # A row for each word of the filter, set or not, so that words stand in order without gaps.
    every_word = keys.sparkSession.range(blocks * _WORDS).select(
        F.expr(f"cast(id div {_WORDS} as int)").alias("block"),
        F.expr(f"cast(id % {_WORDS} as int)").alias("word"), F.lit(0).cast("bigint").alias("bits"),
    )
    merged = words.unionByName(every_word).groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return merged.groupBy("block").agg(in_order.alias("words")).select(
        "block", F.col("words.bits").alias("words")
    )


def maybe_known(df: DataFrame, column: str, found: DataFrame, blocks: int) -> DataFrame:
    """Rows of `df` whose `column` may be among the keys of a `key_filter`.

    Every row with such a key stays, and some without: one in twenty at eight bits a
    key, more if the filter is at its greatest size.  Rows with a null go.  The filter
    is broadcast (`MOST_BITS` bound it), so no row moves and a hot key costs nothing.
    """
    block, first, second = _places(F.col(column), blocks)
    # Longer than any column of `df`, so that none has the same name.
    prefix = "_" * (1 + max(map(len, df.columns)))
    own_block, own_words = f"{prefix}block", f"{prefix}words"
    held = F.broadcast(found.select(F.col("block").alias(own_block), F.col("words").alias(own_words)))

    def is_set(bit: Column) -> Column:
        word = F.get(F.col(own_words), F.shiftright(bit, 6))
        return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit % 64)) != 0

    test = (F.col(own_block) == block) & F.col(column).isNotNull() & is_set(first) & is_set(second)
    return df.join(held, test, "left_semi")


def _places(key: Column, blocks: int) -> tuple[Column, Column, Column]:
    """The block of a key and its two bits in it, from disjoint parts of a 64-bit hash."""
    digest = F.xxhash64(key)
    first = digest.bitwiseAND(BLOCK_BITS - 1).cast("int")
    second = F.shiftrightunsigned(digest, 15).bitwiseAND(BLOCK_BITS - 1).cast("int")
    block = F.shiftrightunsigned(digest, 30).bitwiseAND(blocks - 1).cast("int")
    return block, first, second
