import math
import re
from collections import Counter

import plain
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oddities import LONG, ODD, PASSAGE, empty, odd  # noqa: F401
from orderlens.llm import term_search

ITEMS = [
    (1, PASSAGE), (2, "word"), (3, None), (4, " .!\n"), (5, "again, AND again one_long text"), (5, "Ünïcode"),
    (6, "a b c d"), (7, "nowhere zzz"), (None, "key word"), (8, "x" * 3000), (9, "ας ΑΣ the THE K"), (2, "WORD"),
]


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", plain.lower(text))


def search(rows, items, top=50):
    """{(item, rank): (key, score)} by the definitions; rows are [(key, text)]."""
    counted = [(key, Counter(terms(text))) for key, text in rows]
    n_documents = sum(1 for _, c in counted if c)
    length = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    result = {}
    for item, own in wanted.items():
        scored = []
        for key, c in counted:
            if not c:
                continue
            m = 50 + 50 * c.total() * n_documents // length
            score = sum(
                math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in own if t in c
            )
            if score > 0:
                scored.append((-score, key is not None, key if key is not None else 0))
        for rank, (score, there, key) in enumerate(sorted(scored)[:top], 1):
            result[item, rank] = (key if there else None, -score)
    return result


def collected(found, key="doc_id"):
    rows = found.collect()
    result = {(r.item_id, r["rank"]): (r[key], r.score) for r in rows}
    assert len(result) == len(rows) and found.columns == ["item_id", "rank", key, "score"]
    return result


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*r, "x", "y") for r in ITEMS], "item_id bigint, text string, item string, term string")


def test_equals_plain(spark, small):
    got = collected(entry.queries()["op13_term_search"](spark, small))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert got == search(rows, items)


@pytest.mark.parametrize("top, chars", [(3, 1), (50, 60), (50, term_search.AUTOMATON_CHARS)])
def test_odd_rows(odd, items, top, chars):
    got = collected(term_search.ranked(odd, items, top=top, automaton_chars=chars))
    assert got == search(ODD, ITEMS, top)
    assert {7, 3, 4}.isdisjoint(i for i, _ in got) and (9, 1) in got


def test_ties_and_copies_beyond_the_top(spark, items):
    """Many equal documents, in one task and over several, with scores that tie."""
    rows = [(1000 - i, "word again") for i in range(400)] + [(i, f"word {i}") for i in range(2000, 2300)]
    documents = spark.createDataFrame(rows, "doc_id int, text string").repartition(7)
    assert collected(term_search.ranked(documents, items)) == search(rows, ITEMS)


def test_keys_of_other_types(spark, items):
    rows = [(f"k{i}", t) for i, (_, t) in enumerate(ODD)]
    documents = spark.createDataFrame(rows, "name string, body string")
    names = items.select(F.concat(F.lit("i"), "item_id").alias("item_id"), "text")
    got = collected(term_search.ranked(documents, names, text="body", key="name"), "name")
    assert got == search(rows, [(i and f"i{i}", t) for i, t in ITEMS])


def test_empty_tables(spark, odd, empty, items):
    found = term_search.ranked(odd, items.limit(0))
    assert found.count() == 0 and dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert term_search.ranked(empty, items).count() == 0
    assert term_search.ranked(odd.filter("text IS NULL"), items).count() == 0


class Shared:
    def __init__(self, value):
        self.value = value


@given(st.text("abAB 1.,_éK\n\x00", max_size=60), st.integers(1, 9))
def test_scan_counts_terms(text, size):
    words = ["a", "ab", "b", "é", "1a", "K", "aé", "ba"]
    kept, term_search.SLICE_BYTES = term_search.SLICE_BYTES, size
    try:
        found = term_search._scanner(Shared(words))()([text])
    finally:
        term_search.SLICE_BYTES = kept
    own = Counter(terms(text))
    assert found["n"] == [own.total()]
    assert dict(zip(found["terms"][0], found["counts"][0])) == {i: own[w] for i, w in enumerate(words) if w in own}


def test_very_long_text_is_read_whole():
    scan = term_search._scanner(Shared(["again", "long"]))()
    text = LONG * 12 + "x" * 3_000_000 + " long"
    found = scan([text])
    assert found["n"] == [len(terms(text))] and len(text.encode()) > 4 * term_search.SLICE_BYTES
    assert dict(zip(found["terms"][0], found["counts"][0])) == {0: text.count("again"), 1: text.count("long")}
