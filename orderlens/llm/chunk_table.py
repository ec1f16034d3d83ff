"""Ids of chunks of text, found for many chunks at once and remembered in flat arrays."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa

#: Gives the ids of some chunks, all in one array, and how many each has.
Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]

#: Masks that keep the first n bytes of a little-endian number.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class ChunkTable:
    """Chunk number i has ids flat[begin[i] : begin[i] + count[i]].

    A chunk of up to 16 bytes, none of them zero, is its own key as two 64-bit numbers;
    keys are looked up in an open hash table and compared in full.  Other chunks are
    found in a dict.  About `most` chunks are held: a table that has more is emptied
    before it is used again.
    """

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.size = self.used = 0
        self._slots(max(4, (2 * self.most).bit_length()))
        self.low, self.high = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)
        self.begin, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.flat = np.zeros(4096, np.uint32)
        self.other: dict[bytes, int] = {}

    def _slots(self, bits: int) -> None:
        self.bits = bits
        self.slots = np.full(1 << bits, -1, np.int32)

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = low * np.uint64(0x9E3779B97F4A7C15) ^ (high + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a row of chunks, and where in them each chunk starts (and the last ends)."""
        counts = self.count[numbers]
        upto = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        shift = np.repeat(self.begin[numbers] - upto[:-1], counts)
        return self.flat[shift + np.arange(upto[-1])], upto

    def numbers(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray, encode: Encode) -> np.ndarray:
        """The number of each chunk buffer[start:end]; those that are new are encoded."""
        if self.size > self.most:
            self.clear()
        padded = np.frombuffer(buffer + bytes(16), np.uint8)
        eight = np.ndarray((len(buffer) + 9,), "<u8", padded, strides=(1,))
        sizes = ends - starts
        keyed = sizes <= 16
        if b"\0" in buffer:
            zeros = np.concatenate(([0], np.cumsum(padded[: len(buffer)] == 0)))
            keyed &= zeros[ends] == zeros[starts]
        short, rest = np.flatnonzero(keyed), np.flatnonzero(~keyed)
        begin, size = starts[short], sizes[short]
        low = eight[begin] & _FIRST_BYTES[np.minimum(size, 8)]
        high = eight[begin + 8 * (size > 8)] & _FIRST_BYTES[np.clip(size - 8, 0, 8)]
        result = np.empty(len(starts), np.int64)
        result[short], fresh = self._enter(low, high)
        fresh = short[fresh]
        wanted = [buffer[a:b] for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())]
        words = [buffer[a:b] for a, b in zip(starts[rest].tolist(), ends[rest].tolist())]
        for word in words:
            if word not in self.other:
                self.other[word] = self.size
                self.size += 1
                wanted.append(word)
        if wanted:
            self._learn(wanted, encode)
        result[rest] = [self.other[w] for w in words]
        return result

    def _enter(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of keys, and for each new number, in order, a place in `low` with its key."""
        result, fresh = np.empty(len(low), np.int64), []
        left, slot = np.arange(len(low)), self._slot(low, high)
        while len(left):
            empty = np.flatnonzero(self.slots[slot] < 0)
            if len(empty):
                # Of keys that meet in an empty slot one gets it; the others compare with it.
                self.slots[slot[empty]] = empty
                won = empty[self.slots[slot[empty]] == empty]
                self._room(len(won))
                numbers = np.arange(self.size, self.size + len(won))
                self.slots[slot[won]] = numbers
                self.low[numbers], self.high[numbers] = low[left[won]], high[left[won]]
                fresh.append(left[won])
                self.size += len(won)
            there = self.slots[slot]
            same = (self.low[there] == low[left]) & (self.high[there] == high[left])
            result[left[same]] = there[same]
            left, slot = left[~same], (slot[~same] + 1) & ((1 << self.bits) - 1)
            if 2 * self.size > len(self.slots):  # a single text with very many chunks
                self._grow()
                slot = self._slot(low[left], high[left])
        return result, np.concatenate(fresh) if fresh else np.zeros(0, np.int64)

    def _room(self, more: int) -> None:
        for name in ("low", "high"):
            held = getattr(self, name)
            if self.size + more > len(held):
                setattr(self, name, np.concatenate([held, np.zeros(self.size + more, held.dtype)]))

    def _grow(self) -> None:
        numbers = self.slots[self.slots >= 0]
        self._slots((4 * self.size).bit_length())
        slot_of = self._slot(self.low[numbers], self.high[numbers])
        while len(numbers):
            free = self.slots[slot_of] < 0
            self.slots[slot_of[free]] = numbers[free]
            on = self.slots[slot_of] != numbers
            numbers, slot_of = numbers[on], (slot_of[on] + 1) & ((1 << self.bits) - 1)

    def _learn(self, wanted: list[bytes], encode: Encode) -> None:
        """Keep the ids of the last len(wanted) numbers."""
        flat, counts = encode(wanted)
        first = self.size - len(wanted)
        for name, need in (("begin", self.size), ("count", self.size), ("flat", self.used + len(flat))):
            held = getattr(self, name)
            if need > len(held):
                setattr(self, name, np.concatenate([held, np.zeros(need, held.dtype)]))
        self.begin[first : self.size] = self.used + np.cumsum(counts) - counts
        self.count[first : self.size] = counts
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)


def flat_ids(found: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array and their lengths."""
    lists = list(found)
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    total = int(counts.sum())
    return np.fromiter(chain.from_iterable(lists), np.uint32, total), counts


def release_memory() -> None:
    """Give memory that is free again back to the system: a Python worker serves many tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):
            return  # a C library without it keeps the memory
