"""Substring dedup with sliding spans of sentences.

A text is cut into sentences, at sentence marks and at line breaks.  Every run of
`run` consecutive sentences (more, if they are very short), counted onward from each
sentence and backward from each, is hashed; runs are matched over all documents; and the
sentences that lie in a run which is not the first of its kind are removed.

Sentences of more than a few words (lists, tables, text without marks) are cut further,
at the words that, hashed with the next word, have the least hash among their
neighbours.  Such cuts depend on at most RADIUS + 2 words on either side, hence a
passage is cut alike wherever it stands.

In scripts that set no blanks between words (Chinese, Japanese, Thai and others) every
character is a word, and two of them count as one where the words of a run are counted;
their sentence marks end a sentence without a blank behind them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.chunk_table import release_memory
from orderlens.llm.columns import Texts, free_name, per_text
from orderlens.operators.durable import durable, scratch

RUN = 3
#: A run goes on until it has so many words: fewer say too little to be a copy.
LEAST_WORDS = 10
#: A cut inside a sentence has the least hash among so many words on either side.
RADIUS = 3

# Kinds of characters: 1 blank, 2 sentence mark.
_KIND = np.zeros(1 << 16, np.uint8)
_KIND[[c for c in range(0x3001) if chr(c).isspace()]] = 1
_KIND[[ord(c) for c in ".!?…。！？"]] = 2
_BASE = 0x9E3779B97F4A7C15

#: Characters whose words are hashed at once.
SLICE = 1 << 20

# Ranges of scripts without blanks between words (Thai and Lao, Myanmar,
# Khmer, Chinese and Japanese with their marks, wide forms, further ideographs).
_UNSPACED = ((0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x2E80, 0xA000), (0xF900, 0xFB00),
             (0xFF00, 0xFFF0), (0x20000, 0x32000))

#: Bits of the filter that repeated runs are looked up in (32 MB), at most.
MOST_BITS = 1 << 28

#: Places of rows without a key: behind all keys, ordered by their texts.
_BEHIND = 1 << 62


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans [start, end) that cover the text; blanks belong to the sentence before."""
    return _sentences(text)[0]


def _sentences(text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
    """The spans, and the number of words up to the end of each."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _KIND[np.minimum(codes, len(_KIND) - 1)]
    first, behind, alone = _words(codes, kind == 1)
    n = len(first)
    if not n:
        return [(0, len(text))] if text else [], np.zeros(1 if text else 0, np.int64)
    ends = kind[behind - 1] == 2
    before = np.searchsorted(first, np.flatnonzero(codes == 10)) - 1
    ends[before[before >= 0]] = True
    ends[-1] = True
    upto = np.flatnonzero(_cuts(_hashes(codes, kind, first), ends)) + 1
    edges = [0, *first[upto[:-1]].tolist(), len(text)]
    # Two words of one character each count as one word.
    counted = upto if alone is None else np.maximum(1, np.cumsum(2 - alone)[upto - 1] // 2)
    return list(zip(edges, edges[1:])), counted


def _words(codes: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Starts and ends of words, and which of them are a character of a script without
    blanks; None if there is no such character."""
    starts = np.diff(blank, prepend=True) & ~blank
    stops = np.diff(blank, append=True) & ~blank
    wide = None
    if len(codes) and int(codes.max()) >= _UNSPACED[0][0]:
        wide = np.zeros(len(codes), bool)
        for low, high in _UNSPACED:
            wide |= (codes >= low) & (codes < high)
        wide &= ~blank
        starts |= wide
        starts[1:] |= wide[:-1] & ~blank[1:]
        stops |= wide
        stops[:-1] |= wide[1:] & ~blank[:-1]
    first = np.flatnonzero(starts)
    alone = wide[first] if wide is not None and wide.any() else None
    return first, np.flatnonzero(stops) + 1, alone


@functools.lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE modulo 2**64, and their inverses."""
    found = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(1 << bits, base, np.uint64)
        steps[0] = 1
        found.append(np.cumprod(steps, dtype=np.uint64))
    return found[0], found[1]


def _hashes(codes: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each word with the word behind it."""
    words = np.empty(len(first), np.uint64)
    done = 0
    while done < len(first):
        # Whole words, about SLICE characters of them.
        begin = int(first[done])
        upto = max(done + 1, int(np.searchsorted(first, begin + SLICE)))
        end = int(first[upto]) if upto < len(first) else len(codes)
        # Shorter texts share the powers of the longest slice.
        powers, inverses = _powers(max(16, (end - begin).bit_length()))
        letters = powers[: end - begin] * codes[begin:end]
        letters[kind[begin:end] == 1] = 0
        own = first[done:upto] - begin
        words[done:upto] = _mixed(np.add.reduceat(letters, own) * inverses[own])
        done = upto
    words[:-1] = _mixed(words[:-1] * np.uint64(_BASE) + words[1:])
    return words


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _cuts(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a part ends with each word: sentence ends, and inside of sentences the
    words with the least hash of those around; of equal ones close together the first."""
    cuts, n = ends.copy(), len(ends)
    if n < 2 * RADIUS + 2:
        return cuts
    # All that a cut depends on, the word after the last neighbour too, is one sentence.
    sentence = np.cumsum(ends) - ends
    inside = slice(RADIUS, n - RADIUS - 1)
    least = sentence[: n - 2 * RADIUS - 1] == sentence[2 * RADIUS + 1 :]
    own, clear = hashes[inside], np.ones(len(least), bool)
    for d in range(1, RADIUS + 1):
        left = hashes[RADIUS - d : n - RADIUS - 1 - d]
        least = least & (own <= left) & (own <= hashes[RADIUS + d : n - RADIUS - 1 + d])
        clear &= own < left
    cuts[inside] |= least & clear
    # The same few words over and over: cut as soon as the part is long enough.
    equal = np.flatnonzero(least & ~clear) + RADIUS
    places = np.flatnonzero(cuts)
    behind = np.searchsorted(places, equal)
    before = np.where(behind > 0, places[behind - 1], -1)
    at = -1
    for j, low, high in zip(equal.tolist(), before.tolist(), places[behind].tolist()):
        at = max(at, low)
        if j - at > RADIUS and high - j > RADIUS:
            cuts[j] = True
            at = j
    return cuts


def _parts(text: str | None, run: int) -> tuple[list[tuple[int, int]], list[str], list[tuple[int, int]]]:
    """Spans and words of the sentences that have words; first and end of each run.

    The run from a sentence goes on until it has `run` sentences and LEAST_WORDS words.
    So does the run up to a sentence, backwards: it reaches short sentences at the end
    of a passage, which no run that starts inside the passage may reach.
    """
    spans, words = _sentences(text or "")
    if not len(words) or not words[-1]:
        return [], [], []
    plain = [" ".join(text[a:b].split()) for a, b in spans]
    upto, n = np.append(0, words), len(spans)
    first = np.arange(n + 1)
    onward = np.maximum(first + run, np.searchsorted(upto, upto + LEAST_WORDS))
    back = np.minimum(first - run, np.searchsorted(upto, upto - LEAST_WORDS, "right") - 1)
    # Ends of runs that no run onward has: few, where sentences are very short.
    others = np.flatnonzero((back >= 0) & (onward[np.maximum(back, 0)] != first))
    whole = np.flatnonzero(onward <= n)
    begins = np.concatenate((whole, back[others]))
    ends = np.concatenate((onward[whole], others))
    order = np.lexsort((begins, ends))
    return spans, plain, list(zip(begins[order].tolist(), ends[order].tolist()))


def runs(text: str | None, run: int = RUN) -> tuple[list[tuple[int, int]], list[tuple[bytes, int]]]:
    """Spans of the runs; of each its digest and the number of the next."""
    spans, plain, found = _parts(text, run)
    whole = [(spans[i][0], spans[end - 1][1]) for i, end in found]
    return whole, [(digest, k + 1) for k, digest in enumerate(_digests(plain, found))]


def _digests(plain: list[str], found: list[tuple[int, int]]) -> list[bytes]:
    one = xxhash.xxh3_128_digest
    hashed = b"".join([one(p.encode()) for p in plain])
    return [one(hashed[16 * i : 16 * end]) for i, end in found]


def keep(
    text: str, starts: list[int], own: bool, run: int = RUN
) -> tuple[str, list[tuple[int, int]]]:
    """The text without the runs numbered `starts`, and with `own` without those
    that repeat one of its own; the removed spans, joined where they touch."""
    spans, plain, found = _parts(text, run)
    gone = np.zeros(len(spans), bool)
    repeated = set(starts)
    if own:
        seen: set[bytes] = set()
        for i, digest in enumerate(_digests(plain, found)):
            if digest in seen:
                repeated.add(i)
            seen.add(digest)
    for i in repeated:
        gone[slice(*found[i])] = True
    removed: list[tuple[int, int]] = []
    for (a, b), away in zip(spans, gone):
        if away:
            if removed and removed[-1][1] == a:
                removed[-1] = (removed[-1][0], b)
            else:
                removed.append((a, b))
    edges = [0, *(e for span in removed for e in span), len(text)]
    return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), removed


# --- matching over all documents -------------------------------------------------


def _hashed(documents: DataFrame, text: str, key: str, run: int) -> DataFrame:
    """(place, tie, own, high, low, start) of each text.

    The arrays hold the halves of the digest of each different run and the number of the
    first such run; `own` says whether a run occurs twice in the text.
    """

    def make() -> Callable[[Texts], dict[str, list]]:
        def work(texts: Texts) -> dict[str, list]:
            out: dict[str, list] = {"own": [], "high": [], "low": [], "start": []}
            for text in texts:
                _, plain, places = _parts(text, run)
                digests = _digests(plain, places)
                # The last place given to a digest stays: its first.
                first = dict(zip(reversed(digests), range(len(digests) - 1, -1, -1)))
                halves = np.frombuffer(b"".join(first), "<i8").reshape(-1, 2)
                out["own"].append(len(first) < len(digests))
                out["high"].append(halves[:, 0])
                out["low"].append(halves[:, 1])
                out["start"].append(np.fromiter(first.values(), np.int32, len(first)))
            return out

        return work

    place, tie = placed(key, text)
    fields = "own boolean, high array<bigint>, low array<bigint>, start array<int>"
    hashed = per_text(make, fields, F.col(f"`{text}`"))
    rows = documents.select(place.alias("place"), tie.alias("tie"), hashed.alias("r"))
    return rows.select("place", "tie", "r.*")


def _likely(hashed: DataFrame, filled: Broadcast) -> DataFrame:
    """(place, tie, high, low, start): a row per run that may be repeated."""
    fields = "high array<bigint>, low array<bigint>, start array<int>"
    kind = pa.struct([("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())), ("start", pa.list_(pa.int32()))])

    def run_all(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for high, low, start in batches:
            halves = np.column_stack([high.flatten().to_numpy(), low.flatten().to_numpy()])
            holds = _may_hold(filled.value, halves)
            sizes = pa.compute.list_value_length(high).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(high)), sizes)[holds]
            edges = pa.array(np.searchsorted(row, np.arange(len(high) + 1)), pa.int32())
            columns = [halves[holds, 0], halves[holds, 1], start.flatten().to_numpy()[holds]]
            lists = [pa.ListArray.from_arrays(edges, pa.array(c, f.type.value_type)) for c, f in zip(columns, kind)]
            yield pa.StructArray.from_arrays(lists, fields=list(kind))
        release_memory()

    chosen = F.arrow_udf(run_all, fields).asNondeterministic()
    rows = hashed.select("place", "tie", chosen("high", "low", "start").alias("r"))
    return rows.select("place", "tie", F.inline(F.arrays_zip("r.high", "r.low", "r.start")))


def _may_hold(bits: np.ndarray, halves: np.ndarray) -> np.ndarray:
    mask = 64 * len(bits) - 1
    found = np.ones(len(halves), bool)
    for column in halves.T:
        at = column & mask
        found &= (bits[at >> 6] >> (at & 63) & 1).astype(bool)
    return found


def _filled_bits(several: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter of the repeated runs, as 64-bit words: at most MOST_BITS bits."""
    size = max(64, min(MOST_BITS, 1 << (16 * count).bit_length()))
    places = several.select(F.explode(F.array("high", "low")).alias("half")).select(
        F.col("half").bitwiseAND(F.lit(size - 1)).alias("bit")
    )
    words = places.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")
    )
    bits = np.zeros(size // 64, np.int64)
    found = words.toArrow()
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits


def repeated_runs(documents: DataFrame, text: str = "text", key: str = "doc_id", run: int = RUN) -> DataFrame:
    """(place, tie, starts, own): texts with a run that stands in an earlier document
    (`starts`) or twice in the text (`own`).

    Digests are stored once and go again; what is returned is stored too.  Each different run of a text counts once, and a map-side
    minimum and maximum find the runs that several documents hold, which are stored.
    A Bloom filter of these, of bounded size, keeps most other runs out of the join
    that finds their places; what it lets through by mistake the join removes.
    """
    spark = documents.sparkSession
    with scratch() as held:
        hashed = held.store(_hashed(documents, text, key, run))
        every = hashed.select("place", F.inline(F.arrays_zip("high", "low", "start")))
        several, n = held.counted(
            every.groupBy("high", "low").agg(F.min("place").alias("first"), F.max("place").alias("last"))
            .filter("first < last").select("high", "low", "first")
        )
        filled = spark.sparkContext.broadcast(_filled_bits(several, n))
        # Both sides come straight from a shuffle, so a run of very many documents is split.
        later = _likely(hashed, filled).join(several, ["high", "low"]).filter("place > first")
        own = hashed.filter("own").select("place", "tie", F.lit(None).cast("int").alias("start"))
        found = later.select("place", "tie", "start").unionByName(own)
        # Stored, so that documents are joined to it straight from a scan or a shuffle of
        # their own, which adaptive execution may split, and nothing else has to be kept.
        return durable(
            found.groupBy("place", "tie").agg(
                F.collect_set("start").alias("starts"), F.bool_or(F.col("start").isNull()).alias("own")
            )
        )


def placed(key: str, text: str):
    """A document's place in the order, and a hash that tells texts apart."""
    tie = F.xxhash64(F.col(f"`{text}`").cast("string"))
    behind = F.lit(_BEHIND) + F.shiftrightunsigned(tie, 3)
    return F.coalesce(F.col(f"`{key}`").cast("bigint"), behind), tie


def without_repeats(
    documents: DataFrame, text: str = "text", key: str = "doc_id", run: int = RUN, into: str = "spans"
) -> DataFrame:
    """`documents` and a struct column `into`: text, n_removed, removed.

    Of a repeated passage the parts it begins and ends in may stay, where they go on
    outside of it.  A passage of whole sentences goes wholly.

    `text` is what is left of the text, `removed` the character spans that are gone and
    `n_removed` their number.

    Documents are ordered by `key`, an integer column below 2**62; rows without one
    come last, in the order of a hash of their texts.  The first of equal runs stays,
    so every sentence stays somewhere.  Rows with equal keys are one document: a run
    that two of them share is no repeat.  Null and empty texts have no sentences and
    stay as they are.  If `documents` has a column named `into`, underscores are put
    before the name.  Texts are read twice and shuffled once.
    """
    name = free_name(documents, into)
    place_name, tie_name = free_name(documents, "place"), free_name(documents, "tie")
    starts, own = free_name(documents, "starts"), free_name(documents, "own")
    place, tie = placed(key, text)
    found = repeated_runs(documents, text, key, run).select(
        F.col("place").alias(place_name), F.col("tie").alias(tie_name), F.col("starts").alias(starts),
        F.col("own").alias(own),
    )
    marked = documents.withColumns({place_name: place, tie_name: tie})
    joined = marked.join(found, [place_name, tie_name], "left")
    fields = pa.struct(
        [("text", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
    )

    def run_all(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, begins, owns in batches:
            rows = []
            for one, start, twice in zip(texts, begins, owns):
                left, removed = one.as_py(), []
                if start.is_valid:
                    left, removed = keep(left, start.as_py(), twice.as_py(), run)
                rows.append({"text": left, "removed": [{"start": a, "end": b} for a, b in removed]})
            yield pa.array(rows, fields)
        release_memory()

    kind = "text string, removed array<struct<start: int, end: int>>"
    cleaned = F.arrow_udf(run_all, kind).asNondeterministic()
    value = F.col(f"`{text}`").cast("string")
    found = free_name(joined, "found")
    joined = joined.withColumn(found, cleaned(value, F.col(starts), F.col(own)))
    whole = F.struct(
        F.col(f"{found}.text").alias("text"), F.size(f"{found}.removed").cast("bigint").alias("n_removed"),
        F.col(f"{found}.removed").alias("removed"),
    )
    return joined.withColumn(name, whole).drop(place_name, tie_name, starts, own, found)
