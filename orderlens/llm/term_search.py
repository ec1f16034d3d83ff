"""Ranked lexical search by an Aho-Corasick scan of the documents; no document index.

The terms of all items go, each between two guards, into one automaton that is broadcast
and run over the text itself: what stands between terms becomes the guard, so a term is
found only where it is a whole term.  The scan stores the terms and counts of each
document; totals over the stored rows give the weights, and the automaton's outputs,
term numbers, map to the items that hold the term.  Scores are whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderlens.llm.columns import Texts, per_text
from orderlens.operators.durable import drop, store

TOP = 50
#: Characters of (item, term) pairs in one automaton, about 60 MB in a Python worker.  More
#: items are dealt into several, each of which scans all documents.
AUTOMATON_CHARS = 500_000
#: Bytes of a text that the automaton reads at once.
SLICE_BYTES = 1 << 20
#: Scores of documents against items that a task holds at once.
CELLS = 2_000_000
#: Shares of the documents that are ranked apart before the final ranks of an item.
RANK_SHARES = 32

# Fixed value: a term is made of ASCII letters and digits and of anything beyond ASCII.
_TERM = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_GUARD = b" "
_BETWEEN = bytes(b for b in range(128) if not chr(b).isalnum())
_NORMAL = bytes.maketrans(_UPPER + _BETWEEN, _LOWER + _GUARD * len(_BETWEEN))


def terms(text: Column) -> Column:
    """The terms of a text, in order; null has none."""
    value = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER.decode(), _LOWER.decode())
    return F.regexp_extract_all(value, F.lit(_TERM), F.lit(1))


def ranked(
    documents: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id",
    item_id: str = "item_id", item_text: str = "text", top: int = TOP,
    automaton_chars: int = AUTOMATON_CHARS,
) -> DataFrame:
    """(item_id, rank, key, score): the `top` documents of each item with a score above 0.

    Item rows that share an id (null is one) are one item with the terms of all of them;
    an item without terms has no rows.  Each document row is a document, equal rows
    too; null and empty texts have no terms.  Equal scores are ranked by ascending key,
    a null key first.  Every text is read whole.

    Items come to the driver a block at a time (`automaton_chars`, or one item).  A task
    keeps `top` documents an item; those of all tasks meet in RANK_SHARES groups an item
    before the last ranking, so no task gathers more than a share of them.
    """
    spark = documents.sparkSession
    wanted = items.select(F.col(f"`{item_id}`").alias("item"), F.explode(F.array_distinct(terms(F.col(f"`{item_text}`")))).alias("term"))
    wanted = wanted.distinct().orderBy("item", "term")
    found = None
    for block in _blocks(wanted, automaton_chars):
        best = _ranked_block(documents, block, text, key, wanted.schema["item"].dataType, top)
        found = best if found is None else found.unionByName(best)
    if found is None:
        kinds = (wanted.schema["item"].dataType, documents.schema[key].dataType)
        fields = "item {}, rank int, key {}, score bigint".format(*(k.simpleString() for k in kinds))
        found = spark.createDataFrame([], fields)
    return found.select(F.col("item").alias(item_id), "rank", F.col("key").alias(key), "score")


@dataclass
class Block:
    """Items and their terms: item number i is `items[i]`; `owners` has (term, item) numbers."""

    items: list
    terms: list[str]
    owners: list[tuple[int, int]]


def _blocks(wanted: DataFrame, most: int) -> Iterator[Block]:
    """Whole items in order, as many as `most` characters allow, one at least."""
    block, number, size = Block([], [], []), {}, 0

    def add(item, own: list[str]) -> None:
        for term in own:
            if term not in number:
                number[term] = len(block.terms)
                block.terms.append(term)
            block.owners.append((number[term], len(block.items)))
        block.items.append(item)

    for item, own in _grouped(wanted.toLocalIterator()):
        chars = sum(map(len, own)) + len(own)
        if block.items and size + chars > most:
            yield block
            block, number, size = Block([], [], []), {}, 0
        add(item, own)
        size += chars
    if block.items:
        yield block


def _grouped(rows: Iterator) -> Iterator[tuple]:
    """(item, terms) from rows ordered by item."""
    item, own = None, []
    for row in rows:
        if own and row.item != item:
            yield item, own
            own = []
        item = row.item
        own.append(row.term)
    if own:
        yield item, own


def _scanner(shared: Broadcast) -> Callable[[], Callable[[Texts], dict]]:
    """n (terms with repeats), and the block's terms in a text with their counts."""

    def make():
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        guard = _GUARD.decode()
        for number, term in enumerate(shared.value):
            # One character a byte: no byte of a character beyond ASCII looks like a guard.
            automaton.add_word(guard + term.encode().decode("latin-1") + guard, number)
        automaton.make_automaton()
        output = itemgetter(1)

        def scan(texts: Texts) -> dict[str, list]:
            out = {"n": [], "terms": [], "counts": []}
            for text in texts:
                n, counts = 0, Counter()
                for part in _parts((text or "").encode().translate(_NORMAL)):
                    n += len(part.split())
                    counts.update(map(output, automaton.iter(part.decode("latin-1"))))
                out["n"].append(n)
                out["terms"].append(list(counts))
                out["counts"].append(list(counts.values()))
            return out

        return scan

    return make


def _parts(normal: bytes) -> Iterator[bytes]:
    """A text in parts that end between terms, each between guards."""
    at = 0
    while at < len(normal):
        end = at + SLICE_BYTES
        if end < len(normal):
            end = normal.find(_GUARD, end)
            end = len(normal) if end < 0 else end
        yield _GUARD + normal[at:end] + _GUARD
        at = end


def _ranked_block(documents: DataFrame, block: Block, text: str, key: str, item_type, top: int) -> DataFrame:
    spark = documents.sparkSession
    words = spark.sparkContext.broadcast(block.terms)
    fields = "n bigint, terms array<int>, counts array<int>"
    scanned = documents.select(
        F.col(f"`{key}`").alias("key"), per_text(_scanner(words), fields, F.col(f"`{text}`")).alias("found")
    ).select("key", "found.*")
    # Stored once: the totals must be known before the first score.
    scanned, path = store(scanned.filter("n > 0"))
    total = scanned.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).head()
    holding = scanned.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = np.zeros(len(block.terms), np.int64)  # no larger than the block
    for term, df in holding.collect():
        weight[term] = math.floor(1000 * math.log((2 * total.n + 2) / (2 * df + 1)))
    owners = np.array(sorted(block.owners), np.int64).reshape(-1, 2)
    first = np.searchsorted(owners[:, 0], np.arange(len(block.terms) + 1))
    shared = spark.sparkContext.broadcast((weight, first, owners[:, 1], block.items, total.n, total.length))
    best, _ = store(_top(scanned, shared, item_type, top))
    drop(spark, path)
    return best


def _top(scanned: DataFrame, shared: Broadcast, item_type, top: int) -> DataFrame:
    key_type = scanned.schema["key"].dataType
    item_arrow, key_arrow = to_arrow_type(item_type), to_arrow_type(key_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, first, owner, items, n_documents, length = shared.value
        best = Best(len(items), top, key_arrow)
        step = max(1, CELLS // len(items))
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                few = batch.slice(i, step)
                scores = _scores(few, weight, first, owner, len(items), n_documents, length)
                best.offer(few.column(0), scores)
        found = best.rows()
        item = pa.array(items, item_arrow).take(found.column("item").combine_chunks())
        table = pa.table({"item": item, "key": found.column("key"), "score": found.column("score")})
        yield from table.to_batches()

    fields = f"item {item_type.simpleString()}, key {key_type.simpleString()}, score bigint"
    kept = scanned.mapInArrow(run, fields)
    order = [F.desc("score"), F.asc_nulls_first("key")]
    share = Window.partitionBy("item", "share").orderBy(*order)
    kept = kept.withColumn("share", F.pmod(F.xxhash64("key", "score"), F.lit(RANK_SHARES)))
    kept = kept.withColumn("rank", F.row_number().over(share)).filter(F.col("rank") <= top)
    whole = Window.partitionBy("item").orderBy(*order)
    kept = kept.select("item", F.row_number().over(whole).alias("rank"), "key", "score")
    return kept.filter(F.col("rank") <= top)


def _scores(
    few: pa.RecordBatch, weight: np.ndarray, first: np.ndarray, owner: np.ndarray,
    n_items: int, n_documents: int, length: int,
) -> np.ndarray:
    """Scores of some documents (rows) against all items (columns)."""
    n = few.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
    m = 100 - 50 + (50 * n * n_documents) // length
    lists = few.column(2)
    term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tf = few.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    document = np.repeat(np.arange(len(n)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[document]))
    # Each term counts for all items that hold it.
    count = first[term + 1] - first[term]
    upto = np.cumsum(count)
    places = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - count - first[term], count)
    cell = np.repeat(document * n_items, count) + owner[places]
    scores = np.zeros(len(n) * n_items, np.int64)
    np.add.at(scores, cell, np.repeat(value, count))
    return scores.reshape(len(n), n_items)


class Best:
    """The `top` documents of each item among those offered: greatest score, then least key."""

    def __init__(self, n_items: int, top: int, key_type: pa.DataType):
        self.top = top
        #: A score below this is not among the best of its item.
        self.least = np.ones(n_items, np.int64)
        schema = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("key", key_type)])
        self.held = schema.empty_table()

    def offer(self, keys: pa.Array, scores: np.ndarray) -> None:
        if len(scores) > self.top:
            rank = len(scores) - self.top
            self.least = np.maximum(self.least, np.partition(scores, rank, axis=0)[rank])
        row, item = np.nonzero(scores >= self.least)
        more = pa.table([item, scores[row, item], keys.take(pa.array(row))], schema=self.held.schema)
        self.held = pa.concat_tables([self.held, more])
        if len(self.held) > 4 * self.top * len(self.least):
            self._cut()

    def _cut(self) -> None:
        order = [("item", "ascending"), ("score", "descending"), ("key", "ascending")]
        self.held = self.held.take(pc.sort_indices(self.held, order, null_placement="at_start"))
        item = self.held.column("item").to_numpy()
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = np.flatnonzero(rank == self.top - 1)
        self.least[item[last]] = np.maximum(self.least[item[last]], self.held.column("score").to_numpy()[last])
        self.held = self.held.filter(pa.array(rank < self.top))

    def rows(self) -> pa.Table:
        self._cut()
        return self.held
