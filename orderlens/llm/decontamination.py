"""Benchmark decontamination with an Aho-Corasick automaton over words.

Texts are lower-cased (A-Z) and cut into words of ASCII letters and digits and of
anything beyond ASCII.  A window is `window` consecutive words of a benchmark item;
a shorter item is a single window.  One automaton holds the windows of all items as
sequences of word numbers and reads each document once.  Since normalising keeps
every byte in its place, word positions lead back to offsets in the original text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.columns import Texts, free_name, per_text
from orderlens.operators.durable import store

WINDOW = 10

#: Words of benchmark text in one automaton: about 100 MB in a Python worker. A larger
#: benchmark is dealt into several automata, each of which reads all documents.
AUTOMATON_WORDS = 100_000

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_BLANKS = bytes(b for b in range(128) if not chr(b).isalnum())
_NORMAL = bytes.maketrans(_UPPER + _BLANKS, _LOWER + b" " * len(_BLANKS))

_FIELDS = (
    "n_words bigint, hits array<struct<first: int, last: int, start: int, end: int>>, "
    "items array<string>"
)


def normalised_words(text: str | None) -> list[bytes]:
    """The words of a text; null has none."""
    return (text or "").encode().translate(_NORMAL).split()


def contamination(
    documents: DataFrame, benchmark: DataFrame, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
    automaton_words: int = AUTOMATON_WORDS, into: str = "contamination",
) -> DataFrame:
    """`documents` and a struct column `into`: n_words, hits, items.

    `hits` are the runs of words inside an occurrence of a window, as first and last
    word and as character offsets [start, end) in the original text, in order and
    disjoint; `items` are the ids, sorted as strings, of the items with an occurrence.

    If `documents` has a column named `into`, underscores are put before the name.
    Null texts have no words and no hits.  Items without words, and null items, match
    nothing; an item given twice counts once; an item with a null id marks words but
    is not listed.  An empty benchmark leaves all documents clean.

    The benchmark comes to the driver a block of at most `automaton_words` words (or
    one item) at a time; each further block is one more pass over a stored table.
    """
    into_name, found, result = free_name(documents, into), False, documents
    spark = documents.sparkSession
    for block in _blocks(benchmark, item_id, item_text, automaton_words):
        shared = spark.sparkContext.broadcast(block)
        column = per_text(_scanner(shared, window), _FIELDS, F.col(text))
        if not found:
            result = result.withColumn(into_name, column)
        else:
            result, _ = store(result)
            further = free_name(result, "further")
            result = _merge(result.withColumn(further, column), into_name, further)
        found = True
    if not found:
        nothing = spark.sparkContext.broadcast([])
        column = per_text(_scanner(nothing, window), _FIELDS, F.col(text))
        result = result.withColumn(into_name, column)
    return result


def _blocks(
    benchmark: DataFrame, item_id: str, item_text: str, most: int
) -> Iterator[list[tuple[str | None, str]]]:
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(item_text).cast("string"))
    block, size = [], 0
    for item, text in rows.toLocalIterator():
        n = len(normalised_words(text))
        if not n:
            continue
        if block and size + n > most:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += n
    if block:
        yield block


def _scanner(block: Broadcast, window: int) -> Callable[[], Callable[[Texts], dict]]:
    def make():
        number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in block.value:
            words = [number.setdefault(w, len(number) + 1) for w in normalised_words(text)]
            for i in range(max(1, len(words) - window + 1)):
                owners.setdefault(tuple(words[i : i + window]), set()).add(item)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, items in owners.items():
            automaton.add_word(words, (len(words), items))
        automaton.make_automaton()
        empty = not owners

        def scan(texts: Texts) -> dict[str, list]:
            out = {"n_words": [], "hits": [], "items": []}
            for text in texts:
                words = normalised_words(text)
                runs, items = [], set()
                if words and not empty:
                    # 0 is no word of the benchmark
                    numbers = tuple([number.get(w, 0) for w in words])
                    for last, (length, owning) in automaton.iter(numbers):
                        items |= owning
                        _extend(runs, last - length + 1, last)
                out["n_words"].append(len(words))
                out["hits"].append(_located(text, words, runs) if runs else [])
                out["items"].append(sorted(i for i in items if i is not None))
            return out

        return scan

    return make


def _extend(runs: list[list[int]], first: int, last: int) -> None:
    """Add [first, last]; runs come by ascending `last`, so only the tail can join."""
    while runs and first <= runs[-1][1] + 1:
        first = min(first, runs[-1][0])
        runs.pop()
    runs.append([first, last])


def _located(text: str, words: list[bytes], runs: list[list[int]]) -> list[dict]:
    normal = text.encode().translate(_NORMAL)
    starts, at = [], 0
    for w in words:
        at = normal.index(w, at)
        starts.append(at)
        at += len(w)
    # From bytes to characters: count the bytes that begin a character.
    chars, done, position = {}, 0, 0
    for edge in sorted({e for a, b in runs for e in (starts[a], starts[b] + len(words[b]))}):
        position += len(normal[done:edge].decode(errors="ignore"))
        done = edge
        chars[edge] = position
    return [
        {"first": a, "last": b, "start": chars[starts[a]], "end": chars[starts[b] + len(words[b])]}
        for a, b in runs
    ]


def _merge(df: DataFrame, kept: str, further: str) -> DataFrame:
    """Both blocks' hits as one list of disjoint runs, both blocks' items as one list."""
    merged = F.aggregate(
        F.array_sort(F.concat(f"{kept}.hits", f"{further}.hits")),
        F.slice(f"{kept}.hits", 1, 0),
        lambda runs, run: F.when(
            (F.size(runs) > 0) & (run["first"] <= F.element_at(runs, -1)["last"] + 1),
            F.concat(
                F.slice(runs, 1, F.size(runs) - 1),
                F.array(
                    F.struct(
                        F.element_at(runs, -1)["first"].alias("first"),
                        F.greatest(F.element_at(runs, -1)["last"], run["last"]).alias("last"),
                        F.element_at(runs, -1)["start"].alias("start"),
                        F.greatest(F.element_at(runs, -1)["end"], run["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(runs, F.array(run))),
    )
    items = F.array_sort(F.array_union(f"{kept}.items", f"{further}.items"))
    struct = F.struct(
        F.col(f"{kept}.n_words").alias("n_words"), merged.alias("hits"), items.alias("items")
    )
    return df.withColumn(kept, struct).drop(further)


def hit_words(hits: str):
    """Words in a list of runs."""
    return F.aggregate(
        hits, F.lit(0).cast("bigint"), lambda n, run: n + run["last"] - run["first"] + 1
    )
