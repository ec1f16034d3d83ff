"""Quality rules: an isolation forest over rule statistics.

Each text is described by counts (words, symbols, repeated lines and words, capitals,
exclamation marks).  Trees split random statistics at random values; rows that such
splits isolate early are anomalous.  The threshold on the anomaly score is calibrated
from labelled rows.  Texts that break a base rule are refused whatever their score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.columns import Texts, per_text
from orderlens.llm.sampling import least_hashes
from orderlens.operators.durable import store

#: Bounds of what the driver holds to fit the forest.
SAMPLE_ROWS = 8192
TREES = 200
TREE_ROWS = 256
_SEED = 7

#: Scores lie between 0 and 1; thresholds are multiples of 1 / SCORE_STEPS.
SCORE_STEPS = 4096
#: A threshold that no score reaches.
NEVER = 2.0
#: A good text refused counts as much as so many bad ones kept (as shares of each).
GOOD_WEIGHT = 20.0

MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_capitals", "n_exclamations",
)
_FIELDS = ", ".join(f"{name} bigint" for name in COUNTS)
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANKS = b" \t\n\r\x0b\x0c"


def statistics(text: str | None) -> tuple[int, ...]:
    """The COUNTS of a text. Words are runs without ASCII white space; null has none."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return (0, 0, len(raw) - len(raw.translate(None, _SYMBOLS)), 0, 0, 0, 0, 0, 0)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    compact = raw.translate(None, _BLANKS)
    return (
        len(words),
        len(compact.decode()),
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(codes, len(number)),
        len(lines),
        len(number),
        len(raw) - len(raw.translate(None, _CAPITALS)),
        raw.count(b"!"),
    )


def _repeated(codes: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three that occurs twice or more."""
    if len(codes) < 4:
        return 0
    pairs = codes[:-1] * distinct + codes[1:]
    if distinct >= 1 << 20:  # three numbers would not fit in 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + codes[2:]
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    inside = np.zeros(len(codes), bool)
    for at in (order[1:][same], order[:-1][same]):
        for step in range(3):
            inside[at + step] = True
    return int(inside.sum())


def counts_of(text: Column) -> Column:
    """A struct column of COUNTS."""

    def make():
        def work(texts: Texts) -> dict[str, list]:
            rows = [statistics(t) for t in texts]
            return dict(zip(COUNTS, map(list, zip(*rows))))

        return work

    return per_text(make, _FIELDS, text)


def features(counts: np.ndarray) -> np.ndarray:
    """Rates from rows of COUNTS, on scales where small rates stay apart."""
    c = counts.astype(np.float64)
    words, chars = np.maximum(c[:, 0], 1), np.maximum(c[:, 1], 1)
    symbols, exclamations = c[:, 2] / words, c[:, 8] / words
    return np.column_stack(
        [
            np.sqrt(symbols),
            np.minimum(1, 10 * symbols),
            c[:, 4] / words,
            c[:, 7] / chars,
            np.minimum(1, 10 * exclamations),
        ]
    )


def _mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays; a leaf points to itself and holds its path length."""

    split: np.ndarray
    value: np.ndarray
    below: np.ndarray
    above: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    depth: int
    rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores, 0 to 1; higher is stranger."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.split[at]] < self.value[at], self.below[at], self.above[at])
            total += self.path[at]
        return np.exp2(-total / len(self.roots) / max(_mean_path(self.rows), 1.0))


def fit_forest(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS) -> Forest:
    """An isolation forest; the same rows give the same forest."""
    rng = np.random.default_rng(_SEED)
    tree_rows = max(1, min(tree_rows, len(x)))
    depth = max(1, math.ceil(math.log2(max(2, tree_rows))))
    nodes: list[list] = []

    def grow(rows: np.ndarray, level: int) -> int:
        me = len(nodes)
        nodes.append([0, -np.inf, me, me, level + _mean_path(len(rows))])
        spread = np.flatnonzero(np.ptp(rows, axis=0) > 0) if len(rows) > 1 else []
        if level == depth or not len(spread):
            return me
        column = int(rng.choice(spread))
        low, high = rows[:, column].min(), rows[:, column].max()
        cut = rng.uniform(low, high)
        cut = cut if cut > low else high
        inside = rows[:, column] < cut
        nodes[me][:2] = [column, cut]
        nodes[me][2] = grow(rows[inside], level + 1)
        nodes[me][3] = grow(rows[~inside], level + 1)
        return me

    x = x if len(x) else features(np.zeros((1, len(COUNTS))))
    roots = [
        grow(x[rng.choice(len(x), tree_rows, replace=False)], 0) for _ in range(trees)
    ]
    split, value, below, above, path = (np.array(c) for c in zip(*nodes))
    return Forest(split, value, below, above, path, np.array(roots), depth, tree_rows)


@dataclass(frozen=True)
class Judge:
    """A fitted forest and the score above which a text is refused."""

    forest: Forest
    threshold: float

    def score(self, counts: Column) -> Column:
        """Anomaly scores of a struct column of COUNTS."""
        forest = self.forest

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                columns = [batch.field(n).to_numpy(zero_copy_only=False) for n in COUNTS]
                yield pa.array(forest.scores(features(np.column_stack(columns))))

        return F.arrow_udf(run, "double").asNondeterministic()(counts)


def base_failed(counts: str) -> Column:
    """Too few words, or too many that repeat nearby words."""
    n_words, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n_words < MIN_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)


def fit(counted: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Judge:
    """Fit on labelled rows of `counted` (key, counts).

    The forest takes the SAMPLE_ROWS labelled rows with the least hashes.  The
    threshold is chosen over all labelled rows that pass the base rules: it gains most
    in refused bad rows, as a share, less GOOD_WEIGHT times the share of refused good
    rows.  Labels that are null or belong to no row are ignored; of several for one
    key the greatest holds.  Without a bad and a good labelled row nothing is refused.
    """
    marks = labels.select(F.col(key).alias("_key"), F.col(label).alias("_good")).dropna()
    marks = marks.groupBy("_key").agg(F.max("_good").alias("_good"))
    labelled, _ = store(
        counted.select(F.col(key).alias("_key"), "counts").join(marks, "_key").select("_good", "counts")
    )
    sample = least_hashes(labelled, SAMPLE_ROWS, "counts").select("counts.*").collect()
    forest = fit_forest(features(np.array(sample, dtype=np.int64).reshape(-1, len(COUNTS))))
    judge = Judge(forest, NEVER)
    scored = labelled.filter(~base_failed("counts")).select(
        F.floor(judge.score(F.col("counts")) * SCORE_STEPS).alias("step"), "_good"
    )
    steps = scored.groupBy("step").agg(
        F.count_if(F.col("_good") == 1).alias("good"), F.count_if(F.col("_good") == 0).alias("bad")
    )
    return Judge(forest, _threshold(steps.collect()))


def _threshold(steps: list) -> float:
    """The step whose upper part refuses best; SCORE_STEPS steps at most."""
    good, bad = sum(r.good for r in steps), sum(r.bad for r in steps)
    best, at, refused_good, refused_bad = 0.0, NEVER, 0, 0
    if good and bad:
        for r in sorted(steps, key=lambda r: -r.step):
            refused_good += r.good
            refused_bad += r.bad
            gain = refused_bad / bad - GOOD_WEIGHT * refused_good / good
            if gain > best:
                best, at = gain, r.step / SCORE_STEPS
    return at


def judged(counted: DataFrame, judge: Judge) -> DataFrame:
    """`counted` with score, base_failed and kept."""
    scored = counted.withColumn("score", judge.score(F.col("counts")))
    return scored.withColumn("base_failed", base_failed("counts")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") < judge.threshold)
    )


def count_texts(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, counts) of each document, as a stored table.

    A null text has no words and so fails the base rules; so does an empty one.
    Equal rows are judged each for itself, alike.  Other columns are not read.
    """
    return store(documents.select(key, counts_of(F.col(f"`{text}`")).alias("counts")))[0]


def accepted(
    documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The documents that are kept, with all their columns.

    Texts are counted twice, once to fit and once to judge: that is cheaper than
    to shuffle or store whole texts, and rows need no key.
    """
    judge = fit(count_texts(documents, text, key), labels, key)
    own = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    wrapped = documents.select(own.alias("_row"), counts_of(F.col(f"`{text}`")).alias("counts"))
    return judged(wrapped, judge).filter("kept").select("_row.*")
