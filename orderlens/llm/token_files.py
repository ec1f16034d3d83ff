"""Token files compressed by Re-Pair, with random access.

Ids of documents, in key order and each followed by an end id, form one long sequence
that is cut into shards.  In every shard frequent pairs of neighbouring ids are
replaced by new ids (nonterminals), again and again, until no pair is frequent.  A
shard stores the rules, the number of ids each rule stands for, the final sequence,
and where in the expanded sequence every INDEX-th symbol starts, so that any run of
ids can be decoded without the rest.

Each pass over a shard replaces a set of the most frequent pairs at once, not only the
top one; where replacements would overlap, the left one is made.  Passes go on until no
pair occurs LEAST_COUNT times.

A shard's bytes (`pack`) are a little-endian header of five 32-bit numbers (magic,
ids, first nonterminal, rules, symbols), then rules as pairs, rule lengths, the index
and the symbols, as 32-bit numbers but for the symbols, which take 16 bits if all fit.
Shards are rows of a table, because on a cluster only Spark writes to the shared store.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from orderlens.llm.bpe import byte_alphabet
from orderlens.llm.chunk_table import ChunkTable, flat_ids, release_memory
from orderlens.operators.durable import store

END_ID = 2
MAGIC = 0x52_50_41_52
INDEX = 256

#: Ids after which a shard is closed; a document is never split.
SHARD_IDS = 500_000
#: Pairs replaced in a pass over a shard at most, and the least count of such a pair.
PASS_PAIRS = 3_800
LEAST_COUNT = 8
#: Chunks of text remembered by a Python worker, in some 150 MB.
REMEMBERED = 1_500_000
#: Texts that are looked at together.
TEXTS = 512
#: Shards whose starts (three numbers each) are broadcast; more are joined by a shuffle.
BROADCAST_SHARDS = 100_000

SHARD_FIELDS = "part int, shard int, n_ids bigint, keys array<{key}>, lengths array<bigint>, content binary"


# --- Re-Pair -----------------------------------------------------------------


def compress(ids: np.ndarray, first_nonterminal: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): rule i stands for symbol first_nonterminal + i.

    Goes on until no pair of neighbouring symbols occurs LEAST_COUNT times.
    """
    rules: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    made, symbols = first_nonterminal, ids.astype(np.uint64)
    while len(symbols) > 1:
        # Pairs of symbols that fit in 16 bits take half the memory and time.
        single, bits = (np.uint32, 16) if made + PASS_PAIRS <= 1 << 16 else (np.uint64, 32)
        symbols = symbols.astype(single, copy=False)
        keys = symbols[:-1] << single(bits) | symbols[1:]
        chosen = _frequent(keys)
        if not len(chosen):
            break
        at = _positions(chosen, keys)
        hit = chosen[at] == keys
        taken = _every_other(hit)
        used = np.bincount(at[taken], minlength=len(chosen)) > 0
        name = made + np.cumsum(used) - 1
        pairs = chosen[used].astype(np.int64)
        rules.append(np.column_stack([pairs >> bits, pairs & ((1 << bits) - 1)]))
        made += len(pairs)
        symbols[:-1][taken] = name[at[taken]]
        stays = np.ones(len(symbols), bool)
        stays[1:][taken] = False
        symbols = symbols[stays]
    return symbols.astype(np.int64), np.concatenate(rules)


def _frequent(keys: np.ndarray) -> np.ndarray:
    """The most frequent keys, PASS_PAIRS at most, in order."""
    ordered = np.sort(keys)
    edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True])))
    counts = np.diff(edge)
    often = np.flatnonzero(counts >= LEAST_COUNT)
    if len(often) > PASS_PAIRS:
        often = np.sort(often[np.argpartition(-counts[often], PASS_PAIRS)[:PASS_PAIRS]])
    return ordered[edge[often]]


def _positions(chosen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key may stand in `chosen`: a table by hash, which has one per slot.

    Of chosen keys that share a slot all but one are missed; a later pass finds them.
    """
    table = np.zeros(1 << 18, np.uint16)

    def slot(values: np.ndarray) -> np.ndarray:
        if values.dtype == np.uint32:
            return values * np.uint32(0x9E3779B1) >> np.uint32(14)
        return values * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)

    table[slot(chosen)] = np.arange(len(chosen))
    return table[slot(keys)]


def _every_other(hit: np.ndarray) -> np.ndarray:
    """Of each run of neighbouring hits the first, third, fifth and so on."""
    if not (hit[1:] & hit[:-1]).any():
        return hit
    places = np.arange(len(hit), dtype=np.int32)
    start = np.maximum.accumulate(np.where(hit, np.int32(0), places + np.int32(1)))
    return hit & ((places - start) & np.int32(1) == 0)


def pack(ids: np.ndarray, first_nonterminal: int) -> bytes:
    """The bytes of a shard."""
    symbols, rules = compress(ids, first_nonterminal)
    lengths = _rule_lengths(rules, first_nonterminal)
    starts = _starts(symbols, lengths, first_nonterminal)[::INDEX]
    wide = first_nonterminal + len(rules) > 1 << 16
    head = np.array([MAGIC, len(ids), first_nonterminal, len(rules), len(symbols)], "<u4")
    parts = [head, rules.astype("<u4").ravel(), lengths.astype("<u4"), starts.astype("<u4"),
             symbols.astype("<u4" if wide else "<u2")]
    return b"".join(p.tobytes() for p in parts)


def _rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """The number of ids of each rule. A rule only uses rules before it."""
    found: list[int] = []
    for a, b in rules.tolist():
        found.append((1 if a < base else found[a - base]) + (1 if b < base else found[b - base]))
    return np.array(found, np.int64)


def _expansions(rules: np.ndarray, lengths: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rules in a row, and where each rule's begin. A rule only uses rules before it."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    begin, size = begins.tolist(), lengths.tolist()
    for at, pair in zip(begin, rules.tolist()):
        for part in pair:
            if part < base:
                flat[at] = part
                at += 1
            else:
                first, n = begin[part - base], size[part - base]
                flat[at : at + n] = flat[first : first + n]
                at += n
    return flat, begins


def _starts(symbols: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    if not len(symbols):
        return np.zeros(0, np.int64)
    inner = symbols >= base
    size = np.ones(len(symbols), np.int64)
    size[inner] = lengths[symbols[inner] - base]
    return np.cumsum(size) - size


class Shard:
    """Reads a packed shard."""

    def __init__(self, content: bytes):
        self.table: tuple[np.ndarray, np.ndarray] | None = None
        head = np.frombuffer(content, "<u4", 5).astype(np.int64)
        if head[0] != MAGIC:
            raise ValueError("not a token shard")
        _, self.n_ids, self.base, n_rules, n_symbols = head.tolist()
        n_index = -(-n_symbols // INDEX)
        numbers = np.frombuffer(content, "<u4", 3 * n_rules + n_index, 20).astype(np.int64)
        self.rules = numbers[: 2 * n_rules].reshape(-1, 2)
        self.lengths = numbers[2 * n_rules : 3 * n_rules]
        self.index = numbers[3 * n_rules :]
        at = 20 + 4 * len(numbers)
        wide = self.base + n_rules > 1 << 16
        self.symbols = np.frombuffer(content, "<u4" if wide else "<u2", n_symbols, at)
        if at + self.symbols.nbytes != len(content):
            raise ValueError("a token shard is cut short or too long")

    def ids(self, start: int = 0, count: int | None = None) -> np.ndarray:
        """Ids [start, start + count) of the expanded sequence; only what they need is read."""
        count = self.n_ids - start if count is None else count
        if count <= 0:
            return np.zeros(0, np.int64)
        block = int(np.searchsorted(self.index, start, side="right")) - 1
        after = int(np.searchsorted(self.index, start + count, side="left"))
        part = self.symbols[block * INDEX : after * INDEX].astype(np.int64)
        skip = start - int(self.index[block])
        return self._expanded(part)[skip : skip + count]

    def _expanded(self, part: np.ndarray) -> np.ndarray:
        inner = part >= self.base
        flat, begin = self._flat()
        size = np.ones(len(part), np.int64)
        size[inner] = self.lengths[part[inner] - self.base]
        at = np.cumsum(size) - size
        result = np.repeat(part, size)
        # Ids of a rule lie in `flat` from its begin on.
        shift = np.repeat(begin[part[inner] - self.base] - at[inner], size[inner])
        places = np.flatnonzero(np.repeat(inner, size))
        result[places] = flat[places + shift]
        return result

    def _flat(self) -> tuple[np.ndarray, np.ndarray]:
        if self.table is None:
            self.table = _expansions(self.rules, self.lengths, self.base)
        return self.table


# --- encoding ----------------------------------------------------------------


# A blank and Latin letters: every version of Unicode calls these letters.
_LETTERS = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


class ChunkEncoder:
    """Ids of whole texts, as bytes, by a tokenizer file with byte-level rules.

    A text whose white space is single blanks and line breaks between words falls into
    chunks (a word with the blank before it, a line break, a full stop or comma after an
    ASCII letter or digit) that the tokenizer treats alike wherever they stand; each
    distinct chunk is encoded once and remembered.  Any other text goes to the tokenizer
    as it is.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.table = ChunkTable(remembered)
        alphabet = byte_alphabet()
        self.letters = np.array([ord(alphabet[b]) for b in range(256)], "<u4")

    @staticmethod
    def regular(text: str) -> bool:
        """Whether a text falls into chunks."""
        plain = text.replace("\n", " ")
        # Printable text has no white space but blanks, and no zero bytes.
        return plain.isprintable() and not (
            "  " in plain or "<|" in plain or plain[0] == " " or plain[-1] == " "
        )

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids as little-endian 32-bit numbers; a null text is an empty one."""
        result: list[bytes] = [b""] * len(texts)
        group, size = [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.regular(text):
                result[i] = array("I", self._ids([text])[0]).tobytes()
                continue
            group.append(i)
            size += len(text)
            if size > 4 * self.table.most:
                self._encode_group(texts, group, result)
                group, size = [], 0
        self._encode_group(texts, group, result)
        return result

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunk_ids(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks.

        A chunk of letters is one word to the tokenizer's rules, so it goes to its model
        directly, each byte as the letter that stands for it; any other goes through the
        rules as well.
        """
        texts = [c.decode() for c in chunks]
        plain = [i for i, text in enumerate(texts) if _LETTERS.fullmatch(text)]
        raw = np.frombuffer(b"\n".join([chunks[i] for i in plain]), np.uint8)
        spelled = self.letters[raw].tobytes().decode("utf-32-le").split(chr(self.letters[10]))
        found: list[list[int] | None] = [None] * len(chunks)
        tokens = self.tokenizer.model.tokenize
        for i, word in zip(plain, spelled):
            found[i] = [t.id for t in tokens(word)]
        others = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(others, self._ids([texts[i] for i in others])):
            found[i] = ids
        return flat_ids(found)

    def _encode_group(self, texts: list[str | None], group: list[int], result: list[bytes]) -> None:
        if not group:
            return
        coded = [texts[i].encode() for i in group]
        # A line break ends each text; it is no chunk of its own.
        buffer = b"\n".join(coded) + b"\n"
        starts, ends, first = _chunk_edges(buffer, np.array([len(c) for c in coded]))
        ids, upto = self.table.ids(self.table.numbers(buffer, starts, ends, self._chunk_ids))
        ids = ids.astype("<u4", copy=False)
        edges = upto[first].tolist()
        for i, a, b in zip(group, edges, edges[1:]):
            result[i] = ids[a:b].tobytes()


@lru_cache(maxsize=1)
def chunk_encoder(path: str, remembered: int) -> ChunkEncoder:
    """The encoder of this Python worker: its tasks share what it remembers."""
    return ChunkEncoder(path, remembered)


def _chunk_edges(buffer: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all chunks of texts that a line break follows each, and the
    number of the first chunk of each text (with the number of all at the end)."""
    raw = np.frombuffer(buffer, np.uint8)
    blank, line = raw == 32, raw == 10
    after = np.concatenate((blank[1:] | line[1:], [True]))
    plain = ((raw >= 48) & (raw <= 57)) | ((raw >= 65) & (raw <= 90)) | ((raw >= 97) & (raw <= 122))
    mark = ((raw == 44) | (raw == 46)) & after
    mark[1:] &= plain[:-1]
    mark[0] = False
    start = blank | line | mark
    start[1:] |= line[:-1]
    start[0] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(raw))
    close = np.cumsum(lengths + 1) - 1  # the line breaks that were added
    own = np.ones(len(starts), bool)
    own[np.searchsorted(starts, close)] = False
    begin = np.concatenate(([0], close + 1))
    starts, ends = starts[own], ends[own]
    return starts, ends, np.searchsorted(starts, begin)


def write_shards(
    documents: DataFrame, path: str, text: str = "text", key: str = "doc_id",
    end_id: int = END_ID, shard_ids: int = SHARD_IDS, remembered: int = REMEMBERED,
) -> DataFrame:
    """Encode and compress all documents in key order; the stored shards.

    `path` is a tokenizer file that every executor can open.  Null keys come first;
    rows with equal keys are ordered by their texts.  A null text is an empty one and
    gives the end id alone.  Ranges of keys are dealt to tasks; `part` counts the
    ranges, `shard` the shards in one.  An empty table gives no shards.
    """
    kind = documents.schema[key].dataType.simpleString()
    value = F.col(f"`{text}`").cast("string")
    order = [F.col("key").asc_nulls_first(), F.col("tie")]
    rows = documents.select(F.col(f"`{key}`").alias("key"), value.alias("text"), F.xxhash64(value).alias("tie"))
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("key", "text")
    key_type = to_arrow_type(documents.schema[key].dataType)
    names = ["part", "shard", "n_ids", "keys", "lengths", "content"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(key_type), pa.list_(pa.int64()), pa.binary()]
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path, remembered)
        base = max(encoder.size, end_id + 1)
        part, made = TaskContext.get().partitionId(), 0
        keys, coded, size = [], [], 0

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(coded), "<u4")
            row = [part, made, len(ids), keys, [len(c) // 4 for c in coded], pack(ids, base)]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                few = batch.slice(i, TEXTS)
                for one, ids in zip(few.column(0).to_pylist(), encoder.encode(few.column(1).to_pylist())):
                    keys.append(one)
                    coded.append(ids + end)
                    size += len(coded[-1]) // 4
                    if size >= shard_ids:
                        yield closed()
                        made += 1
                        keys, coded, size = [], [], 0
        if keys:
            yield closed()
        release_memory()

    return store(ranged.mapInArrow(run, SHARD_FIELDS.format(key=kind)))[0]


def with_starts(shards: DataFrame) -> DataFrame:
    """Add `start`: the ids of all shards before one.

    Only one row per range of keys meets in a task; inside a range, its shards do.
    Runs a job that counts the shards.
    """
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("_ids")).select(
        "part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before")
    )
    starts = sizes.withColumn("_inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
    starts = starts.select("part", "shard", (F.col("_before") + F.col("_inside")).alias("start"))
    few = shards.select("part").count() <= BROADCAST_SHARDS
    return shards.join(F.broadcast(starts) if few else starts, ["part", "shard"])


def read_documents(shards: DataFrame, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of each document, decoded from its shard."""
    kind = shards.schema["keys"].dataType.elementType
    fields = f"{key} {kind.simpleString()}, start bigint, n_tokens bigint, ids_crc32 bigint"
    names = [key, "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    key_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, content = batch.column(0)[i].as_py(), batch.column(3)[i].as_py()
                keys, lengths = batch.column(1)[i].values, batch.column(2)[i].as_py()
                ids = Shard(content).ids().astype("<u4")
                edges = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
                if edges[-1] != len(ids):
                    raise ValueError("a shard does not hold the ids its documents need")
                spans = list(zip(edges.tolist(), edges[1:].tolist()))
                raw = memoryview(ids.tobytes())
                columns = [
                    keys.cast(key_type),
                    pa.array(start + edges[:-1], pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in spans], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([ids[a:b] for a, b in spans], pa.list_(pa.int32())))
                yield pa.record_batch(columns, names)

    rows = with_starts(shards).select("start", "keys", "lengths", "content")
    return rows.mapInArrow(run, fields + (", ids array<int>" if with_ids else ""))
