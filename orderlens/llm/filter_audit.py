"""What a row of text filters removes in every order they can stand in.

Each document is reduced to the set of filters it fails, a mask.  All that an order of
filters does to a document follows from its mask, so only the cells (part, mask) and
their sizes are folded: every cell goes through the array of all orders with `transform`
and `aggregate`, which gives one struct of counts for each order and step, weighted by
the documents in the cell.  The cells of a part, at most 32, are added element by element.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.durable import drop, store

#: White space between words, as a class of a regular expression.
BLANK = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Limits:
    """When a filter refuses a text: the first four in percent or words."""

    least_words: int = 100
    least_distinct: int = 80
    most_capitals: int = 10
    symbols: str = "#$%&*|"


FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column, limits: Limits = Limits()) -> Column:
    """The filters A to D that a text fails, as bits 1, 2, 4, 8; null is an empty text.

    A text is read whole.  A text without words fails A alone.
    """
    value = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(value, F.lit(f"([^{BLANK}]+)"), F.lit(1))
    n_words = F.size(words)
    fails = [
        n_words < limits.least_words,
        100 * F.size(F.array_distinct(words)) < limits.least_distinct * n_words,
        100 * F.regexp_count(value, F.lit("[A-Z]")) > limits.most_capitals * F.length(value),
        value.rlike("[" + "".join(f"\\x{ord(c):02X}" for c in limits.symbols) + "]"),
    ]
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def cells(
    documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
    part: str = "lang", limits: Limits = Limits(),
) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled good or toxic, stored.

    Filter E (bit 16) refuses a text that stands under a smaller key too, whatever the
    part.  A row without a key is never refused by E and makes no other row a copy;
    rows that share key and text are no copies of each other.  Null and empty text are
    the same text, and so are null and empty parts.  A key with several labels is good
    (toxic) if one of them says 1.

    Texts are compared by their SHA-256.  Rows that share everything are counted before
    anything moves, so neither a text nor a key that a third of the rows share comes to
    one task; what moves is a digest and a few numbers a document.
    """
    spark = documents.sparkSession
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = documents.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(value, 256)).alias("digest"),
        text_mask(value, limits).alias("mask"),
    )
    counted, path = store(rows.groupBy("key", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n")))
    # The first row of each text is looked up by its key as well, which spreads copies.
    first = counted.filter(F.col("key").isNotNull()).groupBy("digest").agg(F.min("key").alias("key"))
    first = first.withColumn("first", F.lit(True))
    is_copy = F.col("key").isNotNull() & F.col("first").isNull()
    judged = (
        counted.join(first, ["key", "digest"], "left")
        .withColumn("mask", F.col("mask") + F.when(is_copy, 16).otherwise(0))
        .groupBy("key", "part", "mask").agg(F.sum("n").alias("n"))
    )
    said = labels.select(F.col(f"`{key}`").alias("key"), "quality", "toxic").filter("key IS NOT NULL")
    flags = said.groupBy("key").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    labelled = judged.join(flags, "key", "left")
    found, _ = store(
        labelled.groupBy("part", "mask").agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )
    drop(spark, path)
    return found


def _orders() -> Column:
    """All orders of the filters, each an array of filter numbers: one constant of the plan."""
    return F.array(*[F.array(*map(F.lit, order)) for order in permutations(range(len(FILTERS)))])


def _steps(order: Column) -> Column:
    """What one cell adds to each step of an order."""

    def step(state: Column, at: Column) -> Column:
        fails = F.expr("mask").bitwiseAND(F.element_at(_bits(), at + 1)) != 0
        here = fails & ~state["gone"]
        gone = state["gone"] | fails
        alone = F.col("mask") == F.element_at(_bits(), at + 1)
        counts = F.struct(
            at.alias("filter"),
            _weight(~gone, "n").alias("kept"),
            _weight(here, "n").alias("removed"),
            _weight(fails & state["gone"], "n").alias("redundant"),
            _weight(alone, "n").alias("unique_fails"),
            _weight(here, "good").alias("good_lost"),
            _weight(here, "toxic").alias("toxic_lost"),
        )
        return F.struct(gone.alias("gone"), F.concat(state["steps"], F.array(counts)).alias("steps"))

    nothing = f"array<struct<filter:int,{','.join(f'{c}:bigint' for c in COUNTS)}>>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(nothing).alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def _bits() -> Column:
    return F.array(*[F.lit(1 << i) for i in range(len(FILTERS))])


def _weight(holds: Column, count: str) -> Column:
    return F.when(holds, F.col(count)).otherwise(F.lit(0).cast("bigint"))


def audited(found: DataFrame) -> DataFrame:
    """One row per part, order and step from `cells`, zeros included.

    Columns: part, filter_order, step, and COUNTS and shapley: the documents that the
    step's filter removes, summed over all orders.
    """
    letters = F.array(*[F.lit(c) for c in FILTERS])
    names = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    folded = found.select("part", F.flatten(F.transform(_orders(), _steps)).alias("counts"))
    # At most 32 arrays of 600 structs meet here, one for each mask.
    gathered = folded.groupBy("part").agg(F.collect_list("counts").alias("all"))
    total = F.aggregate(
        F.slice("all", 2, 31),
        F.element_at("all", 1),
        lambda sums, more: F.zip_with(
            sums, more,
            lambda a, b: F.struct(
                a["filter"].alias("filter"), *[(a[c] + b[c]).alias(c) for c in COUNTS]
            ),
        ),
    )
    summed = gathered.select("part", total.alias("total"))
    by_filter = F.transform(
        F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)),
        lambda f: F.aggregate(
            F.filter("total", lambda c: c["filter"] == f),
            F.lit(0).cast("bigint"), lambda n, c: n + c["removed"],
        ),
    )
    rows = summed.select("part", by_filter.alias("shapley"), F.posexplode("total").alias("at", "c"))
    size = len(FILTERS)
    return rows.select(
        "part",
        F.element_at(names, (F.floor(F.col("at") / size) + 1).cast("int")).alias("filter_order"),
        (F.col("at") % size + 1).cast("int").alias("step"),
        *[F.col(f"c.{c}").alias(c) for c in COUNTS],
        F.element_at("shapley", F.col("c.filter") + 1).alias("shapley"),
    )
