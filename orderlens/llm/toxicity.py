"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features are densities of lexicon words, their nearness to the second person, and
rates of capitals, punctuation and disguised spellings.  The lexicon is a short fixed
list, and word beginnings that labelled toxic texts favour.

The labelled rows are dealt by a checksum of their keys: remainder 0 is held out, 1 to 3
grow the trees, 4 calibrates their scores.  The lexicon for new texts comes from 1 to 4;
trees and calibration see each text through a lexicon made without its fold.  So no
step sees texts on which the one before it was fitted.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.columns import Texts, per_text
from orderlens.llm.sampling import least_hashes
from orderlens.operators.durable import store

FOLDS = 5
FITTED = (1, 2, 3, 4)
#: Labelled rows that are fitted on at most: those with the least hashes of their keys.
LABELLED_ROWS = 60_000
#: Word beginnings in the learned lexicon at most, the least number of toxic texts with
#: one, and the least log-odds.
LEARNED = 3_000
LEAST_TEXTS = 3
LEAST_ODDS = 1.5
#: Words remembered by a task.
REMEMBERED = 300_000

TREES = 60
DEPTH = 3
RATE = 0.15
BINS = 32

# Insults, and second-person pronouns, of four languages.
INSULTS = frozenset(
    "idiot moron stupid loser scum trash clown worthless pathetic disgusting dumb jerk "
    "fool filthy ugly coward imbecile estupido estupida imbecil basura asqueroso payaso "
    "debile connard ordure minable abruti clochard dumm trottel abschaum ekelhaft "
    "wertlos erbärmlich versager idiota imbécile".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos usted tus ti "
    "du dich dir dein deine euch ihr".split()
)
_PLAIN = str.maketrans("013457@$!", "oieastasi")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_STRETCHED = re.compile(r"(.)\1{2,}")
_DISGUISED = re.compile(r"[^\W\d_][\d@$*!#][^\W\d_]")
NEAR = 5

#: Per word: fixed list, learned log-odds, second person, capitals, disguised, stretched.
_PROPERTIES = 6
FEATURES = 12


def bare(word: str) -> str:
    """Letters of a word in lower case, with common disguises undone."""
    plain = word.strip(".,;:!?\"'()[]{}|").lower()
    if not plain.isalpha():
        plain = _NOT_LETTERS.sub("", plain.translate(_PLAIN))
    return _STRETCHED.sub(r"\1", plain)


def beginnings(plain: str) -> set[str]:
    """The first four and the first five letters; a short word is its own beginning."""
    return {plain[:4], plain[:5]} if len(plain) >= 3 else set()


class Reader:
    """Turns texts into features; remembers words."""

    def __init__(self, learned: dict[str, float], remembered: int = REMEMBERED):
        self.learned, self.remembered = learned, remembered
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((1024, _PROPERTIES), np.float32)

    def _learn(self, words: set[str]) -> None:
        if len(self.number) + len(words) > self.remembered:
            self._forget()
        need = len(self.number) + len(words)
        if need > len(self.table):
            larger = np.zeros((2 * need, _PROPERTIES), np.float32)
            larger[: len(self.table)] = self.table
            self.table = larger
        for word in words:
            i = self.number[word] = len(self.number)
            plain = bare(word)
            odds = max((self.learned.get(b, 0.0) for b in beginnings(plain)), default=0.0)
            self.table[i] = (
                plain in INSULTS, odds, plain in SECOND_PERSON,
                len(word) > 1 and word.isupper(),
                _DISGUISED.search(word) is not None, _STRETCHED.search(word) is not None,
            )

    def features(self, text: str | None) -> np.ndarray:
        """FEATURES numbers; all zero for a null text or one without words."""
        words = (text or "").split()
        if not words:
            return np.zeros(FEATURES)
        total = np.zeros(_PROPERTIES)
        strongest, close = 0.0, 0
        for at in range(0, len(words), self.remembered // 2):
            part = words[at : at + self.remembered // 2]
            missing = {w for w in part if w not in self.number}
            if missing:
                if len(self.number) + len(missing) > self.remembered:
                    missing = set(part)
                self._learn(missing)
            rows = self.table[np.fromiter(map(self.number.__getitem__, part), np.int64, len(part))]
            total += rows.sum(axis=0)
            strongest = max(strongest, float(rows[:, 1].max()))
            bad = np.flatnonzero((rows[:, 0] > 0) | (rows[:, 1] > 0))
            people = np.flatnonzero(rows[:, 2] > 0)
            if len(bad) and len(people):
                after = np.searchsorted(people, bad)
                right = np.abs(people[np.minimum(after, len(people) - 1)] - bad)
                left = np.abs(people[np.maximum(after - 1, 0)] - bad)
                close += int((np.minimum(left, right) <= NEAR).sum())
        n, chars = len(words), len(text)
        return np.array(
            [
                total[0] / n, math.log1p(total[0]), total[1] / n, math.log1p(total[1]), strongest,
                close / n, total[3] / n, total[4] / n, total[5] / n,
                text.count("!") / n, sum(map(text.count, ".,;:?")) / chars, math.log1p(n),
            ]
        )


# --- trees ---------------------------------------------------------------------


@dataclass(frozen=True)
class Boosted:
    """Trees of equal depth as arrays (tree, node); a row goes right if x > cut."""

    start: float
    column: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for column, cut, leaf in zip(self.column, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, column[node]] > cut[node])
            total += leaf[node - (1 << DEPTH) + 1]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Boosted trees for log loss, grown from histograms of quantile bins."""
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = math.log(share / (1 - share))
    if not len(y):
        x = np.zeros((0, FEATURES))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(y) else np.zeros(0) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)]) if len(y) else None
    columns, values, outs = [], [], []
    margin = np.full(len(y), start)
    for _ in range(TREES if len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        column, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, many = (1 << level) - 1, 1 << level
            best = np.full(many, 1e-6)
            for f, edges in enumerate(cuts):
                if not len(edges):
                    continue
                slot = (node - first) * BINS + binned[:, f]
                g = np.bincount(slot, grad, many * BINS).reshape(many, BINS)
                h = np.bincount(slot, hess, many * BINS).reshape(many, BINS)
                left_g, left_h = g.cumsum(1), h.cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = (left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1)
                        - all_g**2 / (all_h + 1))[:, : len(edges)]
                at = gain.argmax(1)
                for i in np.flatnonzero(gain[np.arange(many), at] > best):
                    best[i] = gain[i, at[i]]
                    column[first + i], cut[first + i] = f, edges[at[i]]
            node = 2 * node + 1 + (x[np.arange(len(y)), column[node]] > cut[node])
        leaf_of = node - inner
        g, h = np.bincount(leaf_of, grad, leaves), np.bincount(leaf_of, hess, leaves)
        out = RATE * g / (h + 1)
        margin += out[leaf_of]
        columns.append(column)
        values.append(cut)
        outs.append(out)
    shape = (len(outs), inner)
    return Boosted(start, np.array(columns, np.int64).reshape(shape), np.array(values).reshape(shape),
                   np.array(outs).reshape(len(outs), leaves))


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a rising step curve from margins to probabilities (pool adjacent violators).

    One row of either label is added at the ends, so that any sample gives a rising curve.
    """
    order = np.argsort(margin, kind="stable")
    m, v = margin[order], y[order].astype(float)
    low, high = (m[0], m[-1]) if len(m) else (-1.0, 1.0)
    m, v = np.concatenate(([low], m, [high])), np.concatenate(([0.0], v, [1.0]))
    blocks: list[list[float]] = []
    for at, value in zip(m, v):
        blocks.append([value, 1.0, at, at])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            total, n, _, end = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += n
            blocks[-1][3] = end
    points = [(x, b[0] / b[1]) for b in blocks for x in (b[2], b[3])]
    return np.array([p[0] for p in points]), np.array([p[1] for p in points])


@dataclass(frozen=True)
class Model:
    learned: dict[str, float]
    trees: Boosted
    margins: np.ndarray
    chances: np.ndarray

    def chance(self, features: np.ndarray) -> np.ndarray:
        """Calibrated probabilities; ties inside a step are told apart a little."""
        margin = self.trees.margin(features)
        even = 1 / (1 + np.exp(-margin))
        found = np.interp(margin, self.margins, self.chances)
        return np.clip(0.999 * found + 0.001 * even, 0.0, 1.0)


# --- fitting and scoring -------------------------------------------------------


def fold(key: str) -> Column:
    """The part of the labelled rows a key belongs to; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))) % FOLDS


def _features(text: Column, lexicons: dict[int, dict[str, float]], fold: Column) -> Column:
    """Features of labelled texts, each with the lexicon made without its fold."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        readers = {f: Reader(lexicon, REMEMBERED // 4) for f, lexicon in lexicons.items()}
        for texts, folds in batches:
            pairs = zip(texts, folds.to_pylist())
            yield pa.array([readers[f].features(t.as_py()) for t, f in pairs], pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")(text.cast("string"), fold)


def _beginnings(text: Column) -> Column:
    def make() -> Callable[[Texts], dict[str, list]]:
        known: dict[str, set[str]] = {}

        def of(word: str) -> set[str]:
            found = known.get(word)
            if found is None:
                if len(known) > REMEMBERED:
                    known.clear()
                found = known[word] = beginnings(bare(word))
            return found

        return lambda texts: {"b": [list(set().union(*map(of, set((t or "").split())))) for t in texts]}

    return per_text(make, "b array<string>", text)["b"]


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
        label: str = "toxic", labelled_rows: int = LABELLED_ROWS) -> Model:
    """Fit on labelled rows outside the held-out part.

    At most `labelled_rows` labels are used, so that they can be broadcast and texts
    need no shuffle; the driver holds their features.  Labels that are
    null or belong to no row are ignored; of several for one key the greatest holds.
    """
    marks = labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").alias("_label"), fold(key).alias("_fold"))
    marks = marks.dropna().filter("_fold != 0").groupBy("_key", "_fold").agg(F.max("_label").alias("_label"))
    marks, _ = store(marks)
    chosen, _ = store(least_hashes(marks, labelled_rows, "_key"))
    rows = documents.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))

    # At most `labelled_rows` rows of three numbers are broadcast.
    labelled = rows.join(F.broadcast(chosen), "_key").select("_fold", "_label", "_text")
    words, _ = store(labelled.select("_fold", "_label", _beginnings(F.col("_text")).alias("b")))
    texts = {(r["_fold"], r["_label"] == 1): r["count"] for r in words.groupBy("_fold", "_label").count().collect()}
    cells = [
        F.count_if((F.col("_fold") == f) & (F.col("_label") == v)).alias(f"{name}{f}")
        for name, v in (("t", 1), ("c", 0)) for f in FITTED
    ]
    counts = words.select("_fold", "_label", F.explode("b").alias("b")).groupBy("b").agg(*cells)
    toxic_texts = sum((F.col(f"t{f}") for f in FITTED), F.lit(0))
    clean_texts = sum((F.col(f"c{f}") for f in FITTED), F.lit(0))
    # What may enter any of the lexicons: those without one fold ask for as many texts.
    likely = (
        counts.filter(toxic_texts >= LEAST_TEXTS)
        .orderBy(F.desc(toxic_texts / (clean_texts + 1)), F.desc(toxic_texts), "b").limit(2 * LEARNED)
    ).collect()
    lexicons = {f: _lexicon(likely, texts, [g for g in FITTED if g != f]) for f in (0, *FITTED)}
    seen = labelled.select("_fold", "_label", _features(F.col("_text"), lexicons, F.col("_fold")).alias("x"))
    got = sorted(seen.collect(), key=lambda r: (r["_fold"], r["_label"], r.x))

    def part(folds: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        own = [r for r in got if r["_fold"] in folds]
        x = np.array([r.x for r in own]).reshape(-1, FEATURES)
        return x, np.array([r["_label"] == 1 for r in own], float)

    trees = fit_trees(*part(FITTED[:-1]))
    x, y = part(FITTED[-1:])
    return Model(lexicons[0], trees, *fit_isotonic(trees.margin(x), y))


def _lexicon(likely: list, texts: dict[tuple[int, bool], int], folds: list[int]) -> dict[str, float]:
    """Log-odds of the word beginnings that toxic texts of some folds favour most."""
    toxic, clean = (sum(texts.get((f, is_toxic), 0) for f in folds) for is_toxic in (True, False))
    found = []
    for row in likely:
        t, c = (sum(row[f"{name}{f}"] for f in folds) for name in "tc")
        odds = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if t >= LEAST_TEXTS and odds >= LEAST_ODDS:
            found.append((-t * odds, row.b, round(odds, 6)))
    return {b: odds for _, b, odds in sorted(found)[:LEARNED]}


def score(model: Model, text: Column) -> Column:
    """The probability that a text is toxic. A null text is scored like an empty one."""

    def make() -> Callable[[Texts], dict[str, list]]:
        reader = Reader(model.learned)

        def work(texts: Texts) -> dict[str, list]:
            x = np.array([reader.features(t) for t in texts]).reshape(-1, FEATURES)
            return {"score": model.chance(x)}

        return work

    return per_text(make, "score double", text)["score"]
