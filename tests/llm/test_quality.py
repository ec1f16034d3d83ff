import numpy as np
import plain
import pytest

import __spark_entry__ as entry
from oddities import CLASHES, ODD, empty, odd  # noqa: F401
from orderlens.llm import quality


def path_length(forest, root, row):
    at, depth = root, 0
    while forest.below[at] != at:
        at = forest.below[at] if row[forest.split[at]] < forest.value[at] else forest.above[at]
        depth += 1
    return forest.path[at], depth


def test_query_counts_and_verdicts(spark, medium):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    got = entry.queries()["op5_isolation_forest"](spark, medium).collect()
    assert len(got) == len(texts)
    for r in got:
        counts = tuple(r)[1:6]
        assert counts == plain.statistics(texts[r.doc_id])
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)
    judged = [(labels[r.doc_id], r) for r in got if r.doc_id in labels and not r.base_failed]
    good = [r.kept for good, r in judged if good == 1]
    bad = [r.kept for good, r in judged if good == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2
    # One threshold divides the scores.
    refused = [r.score for r in got if not r.kept and not r.base_failed]
    assert max(r.score for r in got if r.kept) < min(refused)


def test_forest_scores_equal_single_walks():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (400, 5)), rng.normal(6, 1, (8, 5)), np.zeros((50, 5))])
    forest = quality.fit_forest(x, trees=30, tree_rows=64)
    scores = forest.scores(x)
    for i in (0, 7, 399, 401, 440):
        walks = [path_length(forest, root, x[i]) for root in forest.roots]
        mean = np.mean([length for length, _ in walks])
        assert np.isclose(scores[i], 2 ** (-mean / quality._mean_path(64)))
        assert all(length >= depth for length, depth in walks)
    assert scores[400:408].min() > np.median(scores[:400])
    assert np.array_equal(scores, quality.fit_forest(x, trees=30, tree_rows=64).scores(x))


@pytest.mark.parametrize("rows", [0, 1, 5])
def test_forests_of_few_or_equal_rows(rows):
    forest = quality.fit_forest(np.ones((rows, 5)))
    assert np.isfinite(forest.scores(np.zeros((3, 5)))).all()


def test_threshold_gains_most():
    class Step:
        def __init__(self, step, good, bad):
            self.step, self.good, self.bad = step, good, bad

    steps = [Step(1000, 990, 0), Step(2000, 6, 1), Step(2500, 0, 30), Step(3000, 4, 60)]
    assert quality._threshold(steps) == 2500 / quality.SCORE_STEPS
    assert quality._threshold([Step(1, 5, 0)]) == quality._threshold([]) == quality.NEVER


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 0), (5, 1), (5, 0), (9, 1), (13, 0), (None, 1), (77, 1), (9, None)], "doc_id bigint, quality int"
    )
    counted = quality.count_texts(odd)
    rows = counted.select("doc_id", "counts.*").collect()
    want = sorted(((k or -1), *plain.statistics(t)) for k, t in ODD)
    assert sorted(((r.doc_id or -1), *tuple(r)[1:6]) for r in rows) == want
    kept = quality.accepted(odd, labels)
    assert kept.columns == odd.columns
    got = kept.collect()
    assert all(plain.statistics(r.text)[0] >= 50 for r in got)
    assert {9, 10} <= {r.doc_id for r in got}
    assert all(getattr(r, c) for r in got for c in CLASHES)
    # Without labels only the base rules refuse.
    judged = quality.judged(counted, quality.fit(counted, labels.limit(0))).collect()
    assert all(r.kept != r.base_failed for r in judged) and len(judged) == len(ODD)
    assert quality.accepted(empty, labels).count() == 0
