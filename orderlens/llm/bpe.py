"""BPE encoding and decoding with forced boundaries.

The vocabulary is a tokenizer file with word ends: text is composed (NFC), lower-cased
and cut into words, whose bytes are symbols, the last one marked as a word end.  Two
neighbouring symbols that stand next to each other in no vocabulary token can never
come to lie in one token, so a cut between them is certain.  Words are cut there, and
the fragments of a batch are merged independently: short ones together, round by round
in flat arrays, long ones each with a queue of its merges.

White-space separated chunks are encoded once and remembered, in a bounded table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import regex
from pyspark.sql import Column
from tokenizers import Tokenizer

from orderlens.llm.chunk_table import ChunkTable, flat_ids
from orderlens.llm.columns import Texts, per_text

#: Chunks remembered by a task.
REMEMBERED = 500_000
#: Bytes of text whose chunks are looked up together.
GROUP_BYTES = 2_000_000
#: Symbols of a fragment beyond which it is merged with a queue.
LONG_FRAGMENT = 64

# Fixed values of the byte-level alphabet: printable bytes stand for themselves, the
# others for the code points from 256 on, in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# Fixed values of the pretokenizer and the word end.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


def byte_alphabet() -> dict[int, str]:
    others = [b for b in range(256) if b not in set(_PRINTABLE)]
    return {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """A tokenizer file as arrays: symbols, merges, and the pairs that may stay together."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*ids.values(), *self.special.values()])
        self.tokens = [""] * self.size
        for token, i in chain(ids.items(), self.special.items()):
            self.tokens[i] = token
        letters = byte_alphabet()
        self.inner = np.array([ids[letters[b]] for b in range(256)])
        self.final = np.array([ids[letters[b] + WORD_END] for b in range(256)])
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made
        self.by_pair = {k: (r, m) for r, (k, m) in enumerate(zip(keys.tolist(), made.tolist()))}
        self.together = self._together(ids, {c: b for b, c in letters.items()})

    def _together(self, ids: dict[str, int], byte_of: dict[str, int]) -> np.ndarray:
        """Flags for (symbol, next symbol) with symbols 0-255 inner, 256-511 final."""
        flags = np.zeros((256, 512), bool)
        for token in ids:
            ended = token.endswith(WORD_END) and token != WORD_END
            symbols = [byte_of[c] for c in (token.removesuffix(WORD_END) if ended else token)]
            for a, b in zip(symbols, symbols[1:]):
                flags[a, b] = True
            if ended and len(symbols) > 1:
                flags[symbols[-2], 256 + symbols[-1]] = True
        return flags

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; len(keys) where there is no merge."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], len(self.keys))

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each word: cut at certain boundaries, merge the fragments, join."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        symbols = raw.copy()
        symbols[ends - 1] += 256
        starts = np.zeros(len(raw), bool)
        starts[0] = True
        starts[ends[:-1]] = True
        starts[1:] |= ~self.together[raw[:-1], symbols[1:]]
        fragment = np.cumsum(starts) - 1
        base = np.where(symbols >= 256, self.final[raw], self.inner[raw])
        ids, owner = self._merge(base, fragment)
        # Fragments lie in words in order, so ids of a word are consecutive.
        word_of_fragment = np.repeat(np.arange(len(words)), lengths)[starts]
        counts = np.bincount(word_of_fragment[owner], minlength=len(words))
        flat, cuts = ids.tolist(), np.concatenate(([0], np.cumsum(counts))).tolist()
        return [tuple(flat[a:b]) for a, b in zip(cuts, cuts[1:])]

    def _merge(self, ids: np.ndarray, fragment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all fragments; the ids that stay and the fragment each belongs to."""
        sizes = np.bincount(fragment)
        long = sizes > LONG_FRAGMENT
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for f in np.flatnonzero(long):
            merged = self._merge_queue(ids[fragment == f].tolist())
            done.append((np.array(merged, np.int64), np.full(len(merged), f)))
        work = ~long[fragment]
        ids, fragment = ids[work], fragment[work]
        none = len(self.keys)
        while len(ids):
            rank = np.full(len(ids), none)
            rank[:-1] = self.rank(ids[:-1], ids[1:])
            last = np.empty(len(ids), bool)
            last[-1] = True
            last[:-1] = fragment[1:] != fragment[:-1]
            rank[last] = none
            first = np.flatnonzero(np.concatenate(([True], last[:-1])))
            least = np.minimum.reduceat(rank, first)
            spans = np.diff(np.append(first, len(ids)))
            least = np.repeat(least, spans)
            finished = least == none
            if finished.any():
                done.append((ids[finished], fragment[finished]))
                going = ~finished
                ids, fragment, rank, least = ids[going], fragment[going], rank[going], least[going]
                if not len(ids):
                    break
            taken = _every_other(rank == least)
            ids = np.where(taken, self.made[np.minimum(rank, none - 1)], ids)
            stays = np.concatenate(([True], ~taken[:-1]))
            ids, fragment = ids[stays], fragment[stays]
        all_ids = np.concatenate([d[0] for d in done])
        owner = np.concatenate([d[1] for d in done])
        order = np.argsort(owner, kind="stable")
        return all_ids[order], owner[order]

    def _merge_queue(self, ids: list[int]) -> list[int]:
        """One fragment of any length in O(n log n)."""
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := self.by_pair.get(ids[i] * self.size + ids[j])):
                heapq.heappush(queue, (found[0], i, ids[i], ids[j]))

        for i in range(len(ids)):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i] = self.by_pair[a * self.size + b][1]
            ids[j] = -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]


def _every_other(hit: np.ndarray) -> np.ndarray:
    """Of each run of neighbouring hits the first, third, fifth and so on."""
    places = np.arange(len(hit))
    start = np.maximum.accumulate(np.where(hit, 0, places + 1))
    return hit & ((places - start) % 2 == 0)


class Encoder:
    """Encodes texts with a vocabulary file; remembers chunks."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.vocabulary = Vocabulary(path)
        self.rules = Tokenizer.from_file(path)
        self.byte_of = {c: b for b, c in byte_alphabet().items()}
        self.word = regex.compile(WORD_PATTERN)
        specials = "|".join(map(regex.escape, sorted(self.vocabulary.special, key=len, reverse=True)))
        self.special = regex.compile(f"({specials})") if specials else None
        self.table = ChunkTable(remembered)

    def _parts(self, chunk: str) -> Iterable[bytes | int]:
        """A chunk's words, and the ids of special tokens found in it."""
        pieces = self.special.split(chunk) if self.special and "<" in chunk else [chunk]
        for i, piece in enumerate(pieces):
            if i % 2:
                yield self.vocabulary.special[piece]
            else:
                yield from self._words(piece)

    def _words(self, piece: str) -> Iterable[bytes]:
        if piece.isascii() or max(piece) < "\u0250":
            plain = piece if piece.isascii() else unicodedata.normalize("NFC", piece)
            return [w.encode() for w in self.word.findall(plain.lower())]
        # Beyond Latin the tables of Python and of the tokenizers library may differ.
        plain = self.rules.normalizer.normalize_str(piece)
        found = self.rules.pre_tokenizer.pre_tokenize_str(plain)
        return [bytes(map(self.byte_of.__getitem__, word)) for word, _ in found]

    def _chunk_ids(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks; a word that several of them hold is encoded once."""
        parts = [list(self._parts(c.decode())) for c in chunks]
        words = list({w for found in parts for w in found if isinstance(w, bytes)})
        ids = dict(zip(words, self.vocabulary.encode_words(words)))
        return flat_ids(
            list(chain.from_iterable((p,) if isinstance(p, int) else ids[p] for p in found)) for found in parts
        )

    def encode(self, texts: Texts) -> list[np.ndarray]:
        """Ids of each text; a null text has none.

        ASCII white space separates chunks for certain: no word holds it, and neither
        composition nor lower-casing reaches across it.
        """
        result: list[np.ndarray] = []
        group: list[bytes] = []
        size = 0
        for text in texts:
            coded = (text or "").encode()
            if group and size + len(coded) > GROUP_BYTES:
                result += self._encode(group)
                group, size = [], 0
            group.append(coded)
            size += len(coded)
        return result + self._encode(group)

    def _encode(self, group: list[bytes]) -> list[np.ndarray]:
        if not group:
            return []
        # Every text begins and ends at white space.
        buffer = b"\n".join([b"", *group, b""])
        raw = np.frombuffer(buffer, np.uint8)
        inside = (raw != 32) & ((raw < 9) | (raw > 13))
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        ids, upto = self.table.ids(self.table.numbers(buffer, starts, ends, self._chunk_ids))
        begins = np.concatenate(([0], np.cumsum([len(g) + 1 for g in group])))
        cuts = upto[np.searchsorted(starts, begins)].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens, joined by a blank: the vocabulary file names no decoder."""
        return " ".join(map(self.vocabulary.tokens.__getitem__, ids))


def encoded(text: Column, path: str, with_ids: bool = False, remembered: int = REMEMBERED) -> Column:
    """A struct of n_tokens, ids_sha256 and decoded_sha256, and the ids if wanted.

    `path` is a vocabulary file that every executor can open.  Null is encoded as an
    empty text.  Whole texts are encoded, of any length.
    """
    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def make() -> Callable[[Texts], dict[str, list]]:
        encoder = Encoder(path, remembered)
        numbers = [str(i) for i in range(encoder.vocabulary.size)]

        def work(texts: Texts) -> dict[str, list]:
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": encoder.encode(texts)}
            for ids in out["ids"]:
                one = ids.tolist()
                out["n_tokens"].append(len(one))
                out["ids_sha256"].append(_hex(" ".join(map(numbers.__getitem__, one))))
                out["decoded_sha256"].append(_hex(encoder.decode(one)))
            return out

        return work

    return per_text(make, fields + (", ids array<int>" if with_ids else ""), text)


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
