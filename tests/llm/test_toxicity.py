import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oddities import ODD, empty, odd  # noqa: F401
from orderlens.llm import toxicity


def fold(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5


def auc(labels, scores):
    good, bad = scores[labels == 0], scores[labels == 1]
    return np.mean([(b > good).mean() + (b == good).mean() / 2 for b in bad])


def test_query_finds_held_out_toxic_texts(spark, medium):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    got = entry.queries()["op9_toxicity"](spark, medium).collect()
    assert len(got) == spark.read.parquet(f"{medium}/documents.parquet").count()
    assert all(r.held_out == (fold(r.doc_id) == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(labels[r.doc_id], r.score) for r in got if r.held_out and r.doc_id in labels]
    y, s = map(np.array, zip(*held))
    assert y.sum() > 3 and auc(y, s) > 0.9
    assert ((s >= 0.5) == y).mean() > 0.93


def corpus(n=400):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        words = [f"w{w}" for w in rng.zipf(1.3, 60) % 500]
        if i % 4 == 0:
            words[5], words[20] = "grumblefoot", "you"
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_held_out_labels_are_not_used_and_new_words_are_learned(spark):
    rows = corpus()
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    turned = [(k, 1 - y if fold(k) == 0 else y) for k, _, y in rows]
    schema = "doc_id bigint, toxic int"
    one = toxicity.fit(documents, spark.createDataFrame([(k, y) for k, _, y in rows], schema))
    two = toxicity.fit(documents, spark.createDataFrame(turned, schema))
    x = np.array([toxicity.Reader(one.learned).features(t) for _, t, _ in rows])
    assert one.learned == two.learned and "grumb" in one.learned
    assert np.array_equal(one.chance(x), two.chance(x))
    y = np.array([y for _, _, y in rows])
    assert ((one.chance(x) >= 0.5) == y).all()


def test_odd_rows_and_labels(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (5, 0), (9, None), (None, 1), (77, 1), (10, 1), (10, 0)], "doc_id bigint, toxic int")
    for known in (labels, labels.limit(0)):
        model = toxicity.fit(odd, known)
        rows = odd.select("doc_id", "text", toxicity.score(model, F.col("text")).alias("s")).collect()
        assert len(rows) == len(ODD) and all(0 <= r.s <= 1 for r in rows)
        assert len({r.s for r in rows if not (r.text or "").strip()}) == 1
    assert empty.select(toxicity.score(model, F.col("text"))).count() == 0


@pytest.mark.parametrize("word, plain", [
    ("Idiot!", "idiot"), ("1d10t", "idiot"), ("st*upid", "stupid"), ("stuuuupid", "stupid"), ("s.c.u.m", "scum"), ("$cum", "scum"),
])
def test_disguises_are_undone(word, plain):
    assert toxicity.bare(word) == plain and plain in toxicity.INSULTS


def test_features_do_not_depend_on_memory():
    texts = [t for _, t in ODD]
    one, two = toxicity.Reader({"word": 2.0}), toxicity.Reader({"word": 2.0}, remembered=4)
    for t in texts[:4] + texts[6:]:
        assert np.allclose(one.features(t), two.features(t), rtol=1e-5)
    assert one.features("you idiot there")[5] == 1 / 3
    assert one.features("idiot " + "x " * 9 + "you")[5] == 0


def test_isotonic_rises_and_fits():
    rng = np.random.default_rng(3)
    margin = rng.normal(0, 2, 500)
    y = (rng.random(500) < 1 / (1 + np.exp(-margin))).astype(float)
    x, p = toxicity.fit_isotonic(margin, y)
    assert (np.diff(x) >= 0).all() and (np.diff(p) >= 0).all() and 0 <= p[0] < p[-1] <= 1
    fitted = np.interp(margin, x, p)
    assert abs(fitted.mean() - y.mean()) < 0.02
    assert toxicity.fit_isotonic(np.zeros(0), np.zeros(0))[1].tolist() == [0.0, 0.0, 1.0, 1.0]


def test_trees_learn_a_rule_and_survive_constant_columns():
    rng = np.random.default_rng(5)
    x = np.zeros((600, toxicity.FEATURES))
    x[:, 0], x[:, 3] = rng.random(600), rng.random(600)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    trees = toxicity.fit_trees(x, y)
    assert ((trees.margin(x) > 0) == y).mean() > 0.95
    assert np.isfinite(toxicity.fit_trees(x[:1], y[:1]).margin(x)).all()
