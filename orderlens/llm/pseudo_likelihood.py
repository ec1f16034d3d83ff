"""Masked pseudo-likelihood: every word predicted from the words on both sides.

Word counts over the whole corpus give a vocabulary and classes of about equal mass:
frequent words have a class of their own, rarer ones share one, and words outside the
vocabulary form the last class, in which `score_all` gives each its share of the counts,
joined from the table of all counts.  A small network reads the classes of WINDOW words on
either side and predicts the class of the word between; the word within its class has
its share of the class's count.  The sum of the log-probabilities of all words of a
text is its score.

The network is trained in numpy on the whole corpus: in each round every task runs
over its texts from the same start, and the weights are averaged by their words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.chunk_table import release_memory
from orderlens.llm.columns import SLICE_CHARS, array_slices, per_text
from orderlens.llm.sampling import most_frequent
from orderlens.operators.durable import drop, store

WINDOW = 2
CLASSES = 64
WIDTH = 8
HIDDEN = 24
#: Words with an entry of their own, at least; the driver and each task hold them.
VOCABULARY = 20_000
#: From some 450,000 distinct words on, entries grow with the root of their number.
ENTRIES_PER_ROOT = 30
BATCH = 1024
#: One round over the corpus for each rate.
RATES = (0.5, 0.1)
_SEED = 11
#: Input class of a place outside the text.
_EDGE = CLASSES + 1

_SHAPES = (
    (CLASSES + 2, WIDTH), (2 * WINDOW * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES + 1), (CLASSES + 1,)
)


@dataclass(frozen=True)
class Words:
    """Vocabulary with classes.

    `share` is the log of a word's share of its class, `mass` the log of a class's share
    of all words; `rest` is the count of all words beyond the vocabulary.
    """

    place: dict[str, int]
    word_class: np.ndarray
    share: np.ndarray
    mass: np.ndarray
    rest: float = 0.0

    def classes(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Class of each word of a text and log share within it."""
        at = self.places(split_words(pa.array([text], pa.string()))[0])
        return self.word_class[at], self.share[at]

    def places(self, words: pa.Array) -> np.ndarray:
        """Places in the vocabulary, -1 for words beyond it."""
        return pc.index_in(words, value_set=self._entries).fill_null(-1).to_numpy().astype(np.int64)

    @cached_property
    def _entries(self) -> pa.Array:
        return pa.array(list(self.place), pa.string())


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as `str.split` cuts them, and where those of each text end."""
    found = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    pieces = found.flatten()
    # White space at either end of a text leaves an empty piece.
    held = pc.not_equal(pieces, "")
    before = np.append(0, np.cumsum(held.to_numpy(zero_copy_only=False)))
    return pieces.filter(held), before[np.cumsum(pc.list_value_length(found).to_numpy())]


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts; counted in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in array_slices(batch.column(0)):
                words, _ = split_words(part)
                held.append(words)
                size += len(words)
                if size > SLICE_CHARS:
                    yield _counts(held)
                    held, size = [], 0
        yield _counts(held)
        del held
        release_memory()

    counted = texts.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counts(words: list[pa.Array]) -> pa.RecordBatch:
    found = pa.chunked_array(words, pa.string()).value_counts()
    return pa.record_batch([found.field("values"), found.field("counts")], ["word", "n"])


def vocabulary(counts: DataFrame, size: int = VOCABULARY) -> Words:
    """The `size` most frequent words; the words beyond share the last class evenly."""
    kept, path = store(counts)
    words = _vocabulary(kept, size)
    drop(counts.sparkSession, path)
    return words


def _vocabulary(kept: DataFrame, size: int) -> Words:
    total = kept.agg(F.sum("n"), F.count(F.lit(1))).first()
    top = most_frequent(kept, size, "n", "word").collect()
    n = np.array([r.n for r in top], np.float64)
    rest, kinds = float(total[0] or 0) - n.sum(), max(1, total[1] - len(top))
    # Classes by the middle of each word's stretch of the cumulated counts.
    middle = (np.cumsum(n) - n / 2) / max(n.sum(), 1.0)
    word_class = np.minimum((middle * CLASSES).astype(np.int64), CLASSES - 1)
    mass = np.bincount(word_class, n, CLASSES) if len(n) else np.ones(CLASSES)
    share = np.log(n / mass[word_class]) if len(n) else n
    unknown = -np.log(kinds if rest else 1.0)
    seen = np.append(mass, rest) + 1.0
    return Words(
        {r.word: i for i, r in enumerate(top)},
        np.append(word_class, CLASSES),
        np.append(share, unknown),
        np.log(seen / seen.sum()),
        rest,
    )


# --- the network ---------------------------------------------------------------


def start_weights(words: Words) -> np.ndarray:
    """Random, but for the last bias: without its inputs the network knows the counts."""
    rng = np.random.default_rng(_SEED)
    parts = [rng.normal(0, 0.3, s) if len(s) == 2 else np.zeros(s) for s in _SHAPES]
    parts[-1] = words.mass
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def _parts(weights: np.ndarray) -> list[np.ndarray]:
    parts, at = [], 0
    for shape in _SHAPES:
        n = int(np.prod(shape))
        parts.append(weights[at : at + n].reshape(shape))
        at += n
    return parts


def contexts(classes: np.ndarray) -> np.ndarray:
    """Classes of the WINDOW words on either side of each word."""
    padded = np.concatenate((np.full(WINDOW, _EDGE), classes, np.full(WINDOW, _EDGE)))
    n = len(classes)
    sides = [d for d in range(2 * WINDOW + 1) if d != WINDOW]
    return np.column_stack([padded[d : d + n] for d in sides])


def _forward(parts: list[np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    # New arrays are changed in place: memory for others takes as long as the arithmetic.
    embedded, inward, bias, outward, level = parts
    x = embedded.take(around, axis=0, mode="clip").reshape(len(around), -1)
    hidden = x @ inward
    hidden += bias
    np.tanh(hidden, out=hidden)
    logits = hidden @ outward
    logits += level
    logits -= logits.max(axis=1, keepdims=True)
    return x, hidden, logits


def log_chances(weights: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Log-probability of each word's class given the words around it."""
    parts, result = _parts(weights), []
    around = contexts(classes)
    for i in range(0, len(classes), 1 << 14):
        _, _, logits = _forward(parts, around[i : i + (1 << 14)])
        own = logits[np.arange(len(logits)), classes[i : i + (1 << 14)]]
        result.append(own - np.log(np.exp(logits, out=logits).sum(axis=1)))
    return np.concatenate(result) if result else np.zeros(0, np.float32)


def train(weights: np.ndarray, classes: np.ndarray, around: np.ndarray, rate: float) -> None:
    """One pass of stochastic gradient descent; changes `weights`."""
    embedded, inward, bias, outward, level = parts = _parts(weights)
    places = np.arange(embedded.size).reshape(embedded.shape)
    for i in range(0, len(classes), BATCH):
        near, own = around[i : i + BATCH], classes[i : i + BATCH]
        x, hidden, chance = _forward(parts, near)
        np.exp(chance, out=chance)
        chance /= chance.sum(axis=1, keepdims=True)
        chance[np.arange(len(own)), own] -= 1
        chance /= len(own)
        back = chance @ outward.T
        outward -= rate * (hidden.T @ chance)
        level -= rate * chance.sum(axis=0)
        np.multiply(hidden, hidden, out=hidden)
        back *= np.subtract(1, hidden, out=hidden)
        to_x = back @ inward.T
        inward -= rate * (x.T @ back)
        bias -= rate * back.sum(axis=0)
        cells = places.take(near, axis=0, mode="clip").ravel()
        embedded -= rate * np.bincount(cells, to_x.ravel(), embedded.size).reshape(embedded.shape)


@dataclass(frozen=True)
class Model:
    words: Words
    weights: np.ndarray

    def score(self, text: str | None) -> tuple[int, float]:
        """Words of a text, and the sum of their conditional log-probabilities."""
        words, ends = split_words(pa.array([text], pa.string()))
        return len(words), self.sums(self.words.places(words), ends)[0]

    def sums(self, places: np.ndarray, ends: np.ndarray) -> list[float]:
        """The sum for each of several texts from the places of their words.

        Each text goes through the network alone, so that the texts beside it do not
        change the last digits of its sum.
        """
        classes, share = self.words.word_class[places], self.words.share[places]
        found = []
        for a, b in zip(np.append(0, ends[:-1]), ends):
            chances = log_chances(self.weights, classes[a:b])
            found.append(float(chances.sum(dtype=np.float64) + share[a:b].sum()))
        return found


def _trained(texts: DataFrame, text: str, words, weights: np.ndarray, rate: float) -> np.ndarray:
    """The average, by words, of the weights that each task ends with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = weights.copy(), 0
        for batch in batches:
            held, n = [], 0
            for part in array_slices(batch.column(0)):
                found, ends = split_words(part)
                classes = words.value.word_class[words.value.places(found)]
                for own_classes in np.split(classes, ends[:-1]):
                    held.append(own_classes)
                    n += len(own_classes)
                    if n >= 64 * BATCH:
                        _train_all(own, held, rate)
                        seen += n
                        held, n = [], 0
            _train_all(own, held, rate)
            seen += n
        release_memory()
        if seen:
            at = pa.array(np.arange(len(own)), pa.int32())
            yield pa.record_batch([at, pa.array(own * float(seen), pa.float64()), pa.array(np.full(len(own), seen))], ["i", "w", "n"])

    sums = texts.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "i int, w double, n bigint")
    found = sums.groupBy("i").agg((F.sum("w") / F.sum("n")).alias("w")).collect()
    result = weights.copy()
    for r in found:
        # Sums of doubles depend on their order in the last digits.
        result[r.i] = round(r.w, 6)
    return result


def _train_all(weights: np.ndarray, held: list[np.ndarray], rate: float) -> None:
    if held:
        train(weights, np.concatenate(held), np.concatenate([contexts(c) for c in held]), rate)


def fit(
    texts: DataFrame, text: str = "text", size: int = VOCABULARY, rates: tuple[float, ...] = RATES
) -> Model:
    """Count words and train on all texts. Null and empty texts have no words."""
    return _fitted(texts, text, vocabulary(word_counts(texts, text), size), rates)


def _fitted(texts: DataFrame, text: str, words: Words, rates: tuple[float, ...]) -> Model:
    shared = texts.sparkSession.sparkContext.broadcast(words)
    weights = start_weights(words)
    for rate in rates:
        weights = _trained(texts, text, shared, weights, rate)
    return Model(words, weights)


def scored(text: Column, model) -> Column:
    """A struct of n_words, log_likelihood (a sum, 0 without words) and its mean per word.

    `model` is a broadcast Model.  Null and empty texts have a null mean.
    """

    def make() -> Callable[[pa.Array], dict[str, list]]:
        def work(texts: pa.Array) -> dict[str, list]:
            words, ends = split_words(texts)
            sums = model.value.sums(model.value.words.places(words), ends)
            sizes = np.diff(ends, prepend=0).tolist()
            return {
                "n_words": sizes,
                "log_likelihood": sums,
                "mean_log_likelihood": [s / n if n else None for n, s in zip(sizes, sums)],
            }

        return work

    return per_text(make, "n_words bigint, log_likelihood double, mean_log_likelihood double", text, arrays=True)


def _distinct(words: pa.Array, rows: np.ndarray, n_rows: int) -> tuple[pa.Array, pa.Array]:
    """For each of `n_rows` texts a list of its different words, and one of their counts."""
    coded = words.dictionary_encode()
    kinds = max(1, len(coded.dictionary))
    pairs, n = np.unique(rows * kinds + coded.indices.to_numpy(), return_counts=True)
    starts = pa.array(np.searchsorted(pairs, np.arange(n_rows + 1) * kinds), pa.int32())
    different = coded.dictionary.take(pa.array(pairs % kinds))
    return pa.ListArray.from_arrays(starts, different), pa.ListArray.from_arrays(starts, pa.array(n, pa.int64()))


def score_all(
    texts: DataFrame, text: str = "text", key: str = "doc_id", size: int | None = None, rates: tuple[float, ...] = RATES
) -> DataFrame:
    """(key, n_words, log_likelihood, mean_log_likelihood): a model of `texts` and their scores.

    Words beyond the vocabulary have their share of its last class by their counts, from
    a join of the different such words of each text with the counts.  All start with the
    share of a word that occurs once, so only words that occur again need the join.  None
    of them is frequent, so no key of the join has many rows.
    """
    counts, _ = store(word_counts(texts, text))
    if size is None:
        size = max(VOCABULARY, int(ENTRIES_PER_ROOT * counts.count() ** 0.5))
    words = _vocabulary(counts, size)
    once = np.append(words.share[:-1], -np.log(max(words.rest, 1.0)))
    model = _fitted(texts, text, replace(words, share=once), rates)
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], dict[str, list]]:
        def work(texts: pa.Array) -> dict[str, list]:
            found, ends = split_words(texts)
            places = shared.value.words.places(found)
            sizes, beyond = np.diff(ends, prepend=0), places < 0
            row = np.repeat(np.arange(len(sizes)), sizes)
            rare, n = _distinct(found.filter(pa.array(beyond)), row[beyond], len(sizes))
            return {"n_words": sizes, "even": shared.value.sums(places, ends), "word": rare, "n": n}

        return work

    fields = "n_words bigint, even double, word array<string>, n array<bigint>"
    found = per_text(make, fields, F.col(f"`{text}`"), arrays=True)
    rows = texts.select(F.col(f"`{key}`").alias("key"), found.alias("r"))
    # Stored, so that the numbers of the rows stay.
    scored, _ = store(rows.select(F.monotonically_increasing_id().alias("row"), "key", "r.*"))
    rare = scored.select("row", F.inline(F.arrays_zip("word", "n"))).join(
        counts.filter("n > 1").withColumnRenamed("n", "count"), "word"
    )
    more = rare.groupBy("row").agg(F.sum(F.col("n") * F.log("count")).alias("more"))
    total = F.col("even") + F.coalesce("more", F.lit(0.0))
    return scored.join(more, "row", "left").select(
        F.col("key").alias(key), "n_words", total.alias("log_likelihood"),
        F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_likelihood"),
    )
