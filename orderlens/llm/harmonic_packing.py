"""Harmonic packing of token ids into sequences of a fixed capacity.

A class holds pieces of one reciprocal of the capacity, capacity // k ids, and a bin of
the class takes a fixed number of pieces, as many as fit.  A document is cut so that all
of its pieces fall on reciprocals: as many whole capacities as it has, then each time the
greatest reciprocal that its rest allows.  The rest shrinks about quadratically, so three
or four pieces do for what is left after whole capacities.  Bins fill up to a few ids.

Every worker fills the bins of its classes on its own.  What is left in bins that never
filled, less than one bin a class, goes into full sequences one piece after the other, the
very last of them into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderlens.llm.chunk_table import release_memory
from orderlens.llm.token_files import REMEMBERED, TEXTS, chunk_encoder

CAPACITY = 2048
END_ID = 1

#: A sequence's number holds the worker's partition above this many bits of its own count.
COUNT_BITS = 33
#: Rows that are handed on together.
ROWS = 8192

#: Key, start, length and ids (as bytes) of a piece, and its document's ids.
Piece = tuple[object, int, int, bytes, int]


@lru_cache(maxsize=1 << 16)
def reciprocals(rest: int, capacity: int) -> tuple[int, ...]:
    """Sizes that a rest below the capacity is cut into, greatest first."""
    sizes = []
    while rest:
        # The least k with capacity // k <= rest.
        size = capacity // (capacity // (rest + 1) + 1)
        sizes.append(size)
        rest -= size
    return tuple(sizes)


def cuts(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, size) of each piece of a document."""
    whole = length - length % capacity
    for start in range(0, whole, capacity):
        yield start, capacity
    for size in reciprocals(length - whole, capacity):
        yield whole, size
        whole += size


class Packer:
    """The open bins of one worker."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[Piece]] = {}
        #: (piece, sequence, offset) of closed sequences.
        self.done: list[tuple[Piece, int, int]] = []

    def add(self, key: object, ids: bytes) -> None:
        """Cut a document and put its pieces into the bins of their classes."""
        length = len(ids) // 4
        for start, size in cuts(length, self.capacity):
            held = self.open.setdefault(size, [])
            held.append((key, start, size, ids[4 * start : 4 * (start + size)], length))
            if len(held) == self.capacity // size:
                self._close(held)
                self.open[size] = []

    def finish(self) -> None:
        """Empty the bins that did not fill, greatest pieces first, cut where a sequence ends."""
        left = [piece for size in sorted(self.open, reverse=True) for piece in self.open[size]]
        self.open = {}
        total = sum(piece[2] for piece in left)
        rest = total % self.capacity
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        pieces = iter(left)
        piece = next(pieces, None)
        for size in sizes:
            held = []
            while size:
                key, start, length, ids, whole = piece
                taken = min(size, length)
                held.append((key, start, taken, ids[: 4 * taken], whole))
                size -= taken
                if taken < length:
                    piece = key, start + taken, length - taken, ids[4 * taken :], whole
                else:
                    piece = next(pieces, None)
            self._close(held)

    def _close(self, held: list[Piece]) -> None:
        offset = 0
        for piece in held:
            self.done.append((piece, self.next_id, offset))
            offset += piece[2]
        self.next_id += 1


def packed(
    documents: DataFrame, path: str, text: str = "text", key: str = "doc_id",
    end_id: int = END_ID, capacity: int = CAPACITY, remembered: int = REMEMBERED,
    with_ids: bool = False,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), a row per piece.

    `path` is a tokenizer file that every executor can open; `end_id` follows each
    document.  Null and empty texts are the end id alone.  Every row is a document of its
    own, rows with equal or null keys too.  An empty table gives no pieces.  Texts are
    encoded whole; a document of any length is cut into as many pieces as it needs.

    Nothing is shuffled.  A worker holds less than one bin for each of about twice
    the root of `capacity` classes.  Sequence numbers are unique, not dense.
    """
    kind = documents.schema[key].dataType
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    types = [to_arrow_type(kind), *[pa.int64()] * 6] + [pa.list_(pa.int32())] * with_ids
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path, remembered)
        packer = Packer(capacity, TaskContext.get().partitionId() << COUNT_BITS)

        def rows() -> pa.RecordBatch:
            done, packer.done = packer.done, []
            columns = [
                [p[0] for p, _, _ in done], [p[1] for p, _, _ in done], [p[2] for p, _, _ in done],
                [zlib.crc32(p[3]) for p, _, _ in done], [p[4] for p, _, _ in done],
                [s for _, s, _ in done], [o for _, _, o in done],
            ]
            if with_ids:
                columns.append([np.frombuffer(p[3], "<u4") for p, _, _ in done])
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                few = batch.slice(i, TEXTS)
                for one, ids in zip(few.column(0).to_pylist(), encoder.encode(few.column(1).to_pylist())):
                    packer.add(one, ids + end)
                if len(packer.done) >= ROWS:
                    yield rows()
        packer.finish()
        yield rows()
        del packer
        release_memory()

    fields = f"key {kind.simpleString()}, " + ", ".join(f"{n} bigint" for n in names[1:7])
    source = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    found = source.mapInArrow(run, fields + (", ids array<int>" if with_ids else ""))
    return found.withColumnRenamed("key", key)


def padding(used: Column, capacity: int = CAPACITY) -> Column:
    """Ids that a sequence of `used` ids is padded with: none at a power of two."""
    return F.when(F.bit_count(used) == 1, F.lit(0).cast("bigint")).otherwise(F.lit(capacity).cast("bigint") - used)


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, n_pieces, used, padding) of the rows that `packed` gives."""
    found = pieces.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("length").alias("used"))
    return found.withColumn("padding", padding(F.col("used"), capacity))
