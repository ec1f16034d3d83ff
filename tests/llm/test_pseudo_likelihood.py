import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oddities import ODD, empty, odd  # noqa: F401
from orderlens.llm import columns
from orderlens.llm import pseudo_likelihood as lm


def corpus(n=300):
    rng = np.random.default_rng(8)
    texts = []
    for i in range(n):
        # Two languages; in one of them every second word follows from its neighbours.
        words = []
        while len(words) < 80:
            w = int(rng.integers(0, 12))
            words += [f"a{w}", f"b{w}"] if i % 2 else [f"c{w}"]
        texts.append(" ".join(words))
    return texts


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(list(enumerate(corpus())), "doc_id bigint, text string").repartition(4)


@pytest.fixture(scope="module")
def model(documents):
    return lm.fit(documents, rates=(0.5,) * 12)


def slow_score(model, text):
    """Word by word, from the definition."""
    embedded, inward, bias, outward, level = lm._parts(model.weights.astype(np.float64))
    words = (text or "").split()
    classes = [int(model.words.word_class[model.words.place.get(w, -1)]) for w in words]
    total = 0.0
    for i, w in enumerate(words):
        near = [j for j in range(i - lm.WINDOW, i + lm.WINDOW + 1) if j != i]
        x = np.concatenate([embedded[classes[j] if 0 <= j < len(words) else lm._EDGE] for j in near])
        logits = np.tanh(x @ inward + bias) @ outward + level
        total += logits[classes[i]] - math.log(np.exp(logits).sum())
        total += model.words.share[model.words.place.get(w, -1)]
    return len(words), total


def test_scores_equal_the_definition(model):
    for text in [*corpus(3), "a1", "", None, "new words only", "a1 b1 unknown c3"]:
        n, total = model.score(text)
        assert (n, pytest.approx(total, rel=1e-4, abs=1e-6)) == slow_score(model, text)


def test_counts_cover_the_corpus(spark, documents, model):
    want = Counter(w for t in corpus() for w in t.split())
    counts = lm.word_counts(documents)
    assert {r.word: r.n for r in counts.collect()} == want
    words = lm.vocabulary(counts, 5)
    top = sorted(want, key=lambda w: (-want[w], w))[:5]
    assert list(words.place) == top
    assert words.share[-1] == pytest.approx(-math.log(len(want) - 5))
    mass = Counter()
    for w, i in words.place.items():
        mass[words.word_class[i]] += want[w]
    assert all(words.share[i] == pytest.approx(math.log(want[w] / mass[words.word_class[i]])) for w, i in words.place.items())
    # Shares of a class sum to one.
    for c in set(model.words.word_class[:-1]):
        assert np.exp(model.words.share[:-1][model.words.word_class[:-1] == c]).sum() == pytest.approx(1)


def test_training_beats_single_words_and_sees_both_sides(model):
    texts = corpus(340)[300:]
    unigram = Counter(w for t in corpus() for w in t.split())
    total = sum(unigram.values())
    plain = sum(math.log(unigram[w] / total) for t in texts for w in t.split())
    assert sum(model.score(t)[1] for t in texts) > plain + 0.05 * len(texts) * 80
    # A word is likelier between its own neighbours than between others.
    assert model.score("a1 b1 a2 b2 a3 b3")[1] > model.score("a1 a2 a3 b1 b2 b3")[1]


def test_gradient(model):
    rng = np.random.default_rng(6)
    classes = rng.integers(0, lm.CLASSES, 40)
    around = lm.contexts(classes)
    weights = lm.start_weights(model.words).astype(np.float64)
    after = weights.copy()
    lm.train(after, classes, around, 1.0)
    loss = lambda w: -lm.log_chances(w, classes).mean()
    for i in [3, 600, 800, 1300, 1400, 2500, len(weights) - 2]:
        step = np.zeros_like(weights)
        step[i] = 1e-5
        slope = (loss(weights + step) - loss(weights - step)) / 2e-5
        assert weights[i] - after[i] == pytest.approx(slope, abs=1e-4)


def test_odd_rows(spark, odd, empty):
    shared = spark.sparkContext.broadcast(lm.fit(odd))
    rows = odd.select("text", lm.scored(F.col("text"), shared).alias("s")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        n = len((r.text or "").split())
        assert r.s.n_words == n and math.isfinite(r.s.log_likelihood)
        assert (r.s.mean_log_likelihood is None) == (n == 0) and (n == 0) == (r.s.log_likelihood == 0)
    nothing = spark.sparkContext.broadcast(lm.fit(empty))
    assert empty.select(lm.scored(F.col("text"), nothing)).count() == 0
    assert math.isfinite(nothing.value.score("any text")[1])


def test_query_scores_all(spark, small):
    got = entry.queries()["op10_pseudo_likelihood"](spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert {r.doc_id: r.n_words for r in got} == {k: len((t or "").split()) for k, t in texts.items()}
    assert all(r.log_likelihood < 0 for r in got if r.n_words)


def test_words_beyond_the_vocabulary_have_their_own_shares(spark, documents):
    """With three words in the vocabulary, all others are rare; a slow sum over words."""
    rates = (0.5,)
    model = lm.fit(documents, size=3, rates=rates)
    counts = Counter(w for t in corpus() for w in t.split())
    rest = sum(n for w, n in counts.items() if w not in model.words.place)
    got = {r.doc_id: r for r in lm.score_all(documents, size=3, rates=rates).collect()}
    assert len(got) == len(corpus())
    for i, text in enumerate(corpus()):
        rare = [w for w in text.split() if w not in model.words.place]
        n, total = slow_score(model, text)
        total += sum(math.log(counts[w] / rest) - model.words.share[-1] for w in rare)
        assert got[i].n_words == n and got[i].log_likelihood == pytest.approx(total, rel=1e-3)
        assert got[i].mean_log_likelihood == pytest.approx(total / n, rel=1e-3)


def test_scores_of_odd_rows(odd, empty):
    rows = lm.score_all(odd).collect()
    assert sorted(r.n_words for r in rows) == sorted(len((t or "").split()) for _, t in ODD)
    assert all((r.mean_log_likelihood is None) == (r.n_words == 0) for r in rows)
    assert lm.score_all(empty).count() == 0


def test_words_of_many_texts_are_those_of_str_split():
    """Every code point between two letters, and white space at the ends."""
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += [None, "", " \x85\u3000", "\x1c a  b\n", "end"]
    words, ends = lm.split_words(pa.array(texts))
    assert words.to_pylist() == [w for t in texts for w in (t or "").split()]
    assert np.diff(ends, prepend=0).tolist() == [len((t or "").split()) for t in texts]
    words, ends = lm.split_words(pa.array([], pa.string()))
    assert len(words) == len(ends) == 0


def test_array_slices_hold_every_text_once(monkeypatch):
    monkeypatch.setattr(columns, "SLICE_CHARS", 10)
    texts = ["x" * 25, None, "", "abc", "é" * 4, None, "y" * 10, "z"]
    parts = [p.to_pylist() for p in columns.array_slices(pa.array(texts))]
    assert [t for p in parts for t in p] == texts
    assert all(sum(len((t or "").encode()) for t in p[:-1]) < 10 for p in parts) and len(parts) > 2
    assert not list(columns.array_slices(pa.array([], pa.string())))


def test_sums_of_many_texts_equal_those_of_each(model):
    texts = [*corpus(40), None, "", "new words only", "a1 new b1", " "]
    words, ends = lm.split_words(pa.array(texts))
    sums = model.sums(model.words.places(words), ends)
    assert sums == [model.score(t)[1] for t in texts]


def test_different_words_of_texts():
    rows = np.array([0, 0, 0, 2, 2, 2])
    words, n = lm._distinct(pa.array(["a", "b", "a", "b", "c", "c"]), rows, 4)
    got = [dict(zip(w, k)) for w, k in zip(words.to_pylist(), n.to_pylist())]
    assert got == [{"a": 2, "b": 1}, {}, {"b": 1, "c": 2}, {}]
    assert lm._distinct(pa.array([], pa.string()), np.array([], np.int64), 2)[0].to_pylist() == [[], []]


def test_words_that_occur_once_need_no_join(spark):
    texts = ["a a a b once", "a b twice b", None, "a twice"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    scored = lm.score_all(documents, size=2, rates=(0.5,))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(n,1)" in plan
    model = lm.fit(documents, size=2, rates=(0.5,))
    # Three words beyond the vocabulary, `once` and `twice` twice.
    wanted = {0: math.log(1 / 3), 1: math.log(2 / 3), 2: 0.0, 3: math.log(2 / 3)}
    for r in scored.collect():
        rare = wanted[r.doc_id] - (model.words.share[-1] if texts[r.doc_id] else 0.0)
        assert r.log_likelihood == pytest.approx(slow_score(model, texts[r.doc_id])[1] + rare, rel=1e-4)
