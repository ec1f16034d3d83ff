"""SimHash near-duplicates by multi-index hashing.

A fingerprint is 64 bits; bit i is set if it is set in more than half of the hashes
of the text's word shingles.  Texts link if their fingerprints differ in at most two
bits, and linked texts form groups.

Two halves of 32 bits share at most two differing bits, so either the high halves
differ in at most one bit, or the low halves agree.  Each half indexes a table of the
distinct fingerprints; a fingerprint looks up the Hamming ball of radius one around
its high half and the very value of its low half, and each match is verified on all
64 bits.

A slot of the table that holds many fingerprints (variants of one popular text) would
give all their pairs.  Such slots are left out of the lookup.  The fingerprints that
sit in one or look one up are instead linked through the 65 values within one bit of
the whole fingerprint: two fingerprints differ in at most two bits exactly if these
sets meet, so linking each value's visitors to the least of them gives the same
groups with work in proportion to their number.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.columns import Texts, free_name, per_text
from orderlens.llm.components import components
from orderlens.operators.durable import drop, store

SHINGLE_WORDS = 3
MOST_BITS = 2
_SEED = 42

#: Fingerprints of a table slot beyond which its members are linked by values instead.
CROWDED_SLOT = 32


def fingerprint_of(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint as an unsigned number; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, _SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: 1 - shingle_words].tolist(), ends[shingle_words - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], _SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a signed BIGINT of the same bits."""

    def make():
        def work(texts: Texts) -> dict[str, list]:
            whole = [fingerprint_of(t, shingle_words) for t in texts]
            return {"bits": [f - (1 << 64) if f >> 63 else f for f in whole]}

        return work

    return per_text(make, "bits bigint", text)["bits"]


def links(fingerprints: DataFrame, crowded_slot: int = CROWDED_SLOT) -> DataFrame:
    """(a, b): links between distinct fingerprints that give the right groups.

    `fingerprints` has one column of distinct BIGINTs.  All pairs within two bits are
    linked directly, but for those that meet only in a crowded slot, which are linked
    through a common neighbour.  Runs two jobs.
    """
    spark = fingerprints.sparkSession
    f = fingerprints.select(F.col(f"`{fingerprints.columns[0]}`").alias("f"))
    high, low = F.expr("shiftrightunsigned(f, 32)"), F.expr("f & 4294967295L")
    # One bit more than the own half: a pair that differs in one bit of the high half
    # meets once, seen from the side that has the zero.
    ball = F.expr(
        "concat(array(h), filter(transform(sequence(0, 31), i -> h | shiftleft(1L, i)), k -> k != h))"
    )
    halves = f.select("f", high.alias("h"), low.alias("l"))
    table = halves.select(
        "f", F.inline(F.expr("array(struct(0 as half, h as slot), struct(1 as half, l as slot))"))
    )
    lookups = halves.select(
        "f",
        F.inline(
            F.concat(
                F.transform(ball, lambda k: F.struct(F.lit(0).alias("half"), k.alias("slot"))),
                F.expr("array(struct(1 as half, l as slot))"),
            )
        ),
    )
    crowded, _ = store(
        table.groupBy("half", "slot").count().filter(F.col("count") > crowded_slot)
        .select("half", "slot")
    )
    if crowded.isEmpty():
        return _verified(lookups, table)
    # Fingerprints that sit in a crowded slot or look one up.
    visitors, _ = store(
        lookups.join(crowded, ["half", "slot"], "left_semi").select("f").distinct()
    )
    direct = _verified(lookups, table.join(crowded, ["half", "slot"], "left_anti"))
    near = visitors.select(
        "f", F.explode(F.expr("concat(array(f), transform(sequence(0, 63), i -> f ^ shiftleft(1L, i)))")).alias("value")
    )
    part = F.xxhash64("value").alias("_part")
    least = near.groupBy("value", part).agg(F.min("f").alias("b")).drop("_part")
    through = near.join(least, "value").filter("f != b").select(F.col("f").alias("a"), "b")
    return direct.unionByName(through.distinct())


def _verified(lookups: DataFrame, table: DataFrame) -> DataFrame:
    met = lookups.select(F.col("f").alias("a"), "half", "slot").join(
        table.select(F.col("f").alias("b"), "half", "slot"), ["half", "slot"]
    )
    return met.filter(f"a != b AND bit_count(a ^ b) <= {MOST_BITS}").select("a", "b").distinct()


def near_duplicates(
    documents: DataFrame, text: str = "text", key: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS, crowded_slot: int = CROWDED_SLOT,
) -> DataFrame:
    """(key, bits, component): one row per document.

    `component` is the least key of the documents that can be reached by links.  A
    null text counts as one without words; all such texts have fingerprint 0 and link
    to each other.  Rows with equal keys are documents of their own.  A null key
    stays null and never names a group, unless the group has no other.  An empty
    table gives no rows.  Other columns are not read.
    """
    return _grouped(documents, text, key, shingle_words, crowded_slot).drop("tie")


def _grouped(
    documents: DataFrame, text: str, key: str, shingle_words: int, crowded_slot: int
) -> DataFrame:
    """`near_duplicates` with a hash of the text, `tie`."""
    value = F.col(f"`{text}`")
    prints, _ = store(
        documents.select(
            F.col(f"`{key}`").alias("key"), fingerprint(value, shingle_words).alias("bits"),
            F.xxhash64(value.cast("string")).alias("tie"),
        )
    )
    part = F.xxhash64("bits").alias("_part")
    distinct, _ = store(
        prints.groupBy("bits").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
    )
    found, _ = store(components(links(distinct.select("bits"), crowded_slot)))
    members = found.join(distinct.withColumnRenamed("bits", "node"), "node")
    named = members.groupBy("root", F.xxhash64("root").alias("_part")).agg(
        F.min("least").alias("component")
    )
    linked = found.join(named.drop("_part"), "root").select(F.col("node").alias("bits"), "component")
    copied = distinct.filter("copies > 1").join(linked, "bits", "left_anti")
    groups = linked.unionByName(copied.select("bits", F.col("least").alias("component")))
    # One row per fingerprint; the grouping leaves the join a shuffle of its own, so
    # that adaptive execution can split a fingerprint with very many copies.
    groups = groups.groupBy("bits", part).agg(F.first("component").alias("component")).drop("_part")
    joined = prints.join(groups, "bits", "left").select(
        "key", "bits", F.coalesce("component", "key").alias("component"), "tie"
    )
    return joined.withColumnRenamed("key", key)


def representatives(
    documents: DataFrame, text: str = "text", key: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS, crowded_slot: int = CROWDED_SLOT,
) -> DataFrame:
    """The documents without near-duplicates: of each group the one with the least key.

    Of rows that share that key and the fingerprint, one stays: that with the least
    hash of its text, and any one of equal texts.  All columns are kept.
    """
    groups = _grouped(documents, text, key, shingle_words, crowded_slot)
    chosen = (
        groups.filter(F.col(key).eqNullSafe(F.col("component")))
        .groupBy(key, "bits").agg(F.min("tie").alias("tie"))
    )
    # Fields of a struct compare with nulls equal, and the join's shuffle serves the
    # removal of equal rows as well.
    identity = free_name(documents, "identity")
    wanted = chosen.select(F.struct(F.col(key).alias("key"), "tie").alias(identity)).distinct()
    own = F.struct(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("tie"))
    kept = documents.withColumn(identity, own).join(wanted, identity, "left_semi")
    return kept.dropDuplicates([identity]).drop(identity)
