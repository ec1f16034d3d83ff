"""Plain versions of the operators, one text or pair at a time, without Spark."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import xxhash
from tokenizers import Tokenizer


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def fingerprint(text, shingle=3):
    own = words(lower(text))
    if not own:
        return 0
    grams = [" ".join(own[i : i + shingle]) for i in range(max(1, len(own) - shingle + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=2):
    """{key: least key reachable} from [(key, fingerprint)]."""
    groups = [{k} for k, _ in prints]
    at = list(range(len(prints)))
    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= bits and at[i] != at[j]:
                old, new = at[i], at[j]
                groups[new] |= groups[old]
                at = [new if x == old else x for x in at]
    return {k: min(groups[at[i]]) for i, (k, _) in enumerate(prints)}


def statistics(text):
    own = words(text)
    text = text or ""
    windows = Counter(zip(own, own[1:], own[2:]))
    inside = {i + d for i, w in enumerate(zip(own, own[1:], own[2:])) if windows[w] > 1 for d in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside)


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(text, items, window=10):
    """(n_words, n_hit, n_items, sha256 of the items, contaminated)."""
    own, hit, found = benchmark_words(text), set(), set()
    for item, value in items:
        other = benchmark_words(value)
        n = min(window, len(other))
        for w in {tuple(other[i : i + n]) for i in range(len(other) - n + 1)} if n else ():
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) == w:
                    hit |= set(range(i, i + n))
                    found |= {str(item)} if item is not None else set()
    joined = ",".join(sorted(found))
    return len(own), len(hit), len(found), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)


MASK = (1 << 64) - 1
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U00031fff"
TOKEN = re.compile(rf"[^\s{UNSPACED}]+|(?!\s)[{UNSPACED}]")


def mixed(x):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ x >> 33) * factor & MASK
    return x ^ x >> 33


def span_sentences(text, radius=3):
    """[(start, end, words)] of the sentences of a text, by their definition."""
    found = [(m.start(), m.end(), m.group()) for m in TOKEN.finditer(text)]
    if not found:
        return []
    base = 0x9E3779B97F4A7C15
    own = [mixed(sum(ord(c) * pow(base, i, 1 << 64) for i, c in enumerate(w)) & MASK) for _, _, w in found]
    hashes = [mixed(a * base + b & MASK) for a, b in zip(own, own[1:])] + own[-1:]
    n, cuts = len(found), set()
    for i, (_, end, word) in enumerate(found):
        gap = text[end : found[i + 1][0]] if i + 1 < n else "\n"
        if word[-1] in ".!?…。！？" or "\n" in gap:
            cuts.add(i)
    sentence = [sum(1 for c in cuts if c < i) for i in range(n)]
    equal = []
    for i in range(radius, n - radius - 1):
        left, right = hashes[i - radius : i], hashes[i + 1 : i + radius + 1]
        if sentence[i - radius] == sentence[i + radius + 1] and hashes[i] <= min(left + right):
            if hashes[i] < min(left):
                cuts.add(i)
            else:
                equal.append(i)
    marks, at = sorted(cuts), -1
    for j in equal:
        at = max([at, *(c for c in marks if c < j)])
        if j - at > radius and min(c for c in marks if c >= j) - j > radius:
            cuts.add(j)
            at = j
    result, first = [], 0
    for cut in sorted(cuts):
        start = found[first][0] if first else 0
        end = found[cut + 1][0] if cut + 1 < n else len(text)
        result.append((start, end, found[first : cut + 1]))
        first = cut + 1
    return result


def span_runs(text, run=3, least=10):
    """[(first sentence, end, what it says)] of the runs of a text, in order, and its sentences."""
    held = span_sentences(text)
    halves, upto = [0], 0
    for _, _, own in held:
        upto += sum(1 if re.fullmatch(f"[{UNSPACED}]", w) else 2 for _, _, w in own)
        halves.append(max(1, upto // 2))
    says = [" ".join(text[a:b].split()) for a, b, _ in held]
    found = set()
    for i in range(len(held)):
        ends = [e for e in range(i + run, len(held) + 1) if halves[e] - halves[i] >= least]
        if ends:
            found.add((ends[0], i))
    for e in range(len(held) + 1):
        begins = [i for i in range(e - run + 1) if halves[e] - halves[i] >= least]
        if begins:
            found.add((e, begins[-1]))
    return held, [(i, e, tuple(says[i:e])) for e, i in sorted(found)]


def without_repeats(rows):
    """Texts of [(key, text)], in key order, without runs of earlier documents.

    Knows nothing of the operator's code: own sentences, own runs, compared as texts.
    """
    first, result = {}, []
    for key, text in rows:
        held, found = span_runs(text or "")
        gone, own = set(), set()
        for begin, end, says in found:
            if says in own or first.get(says, key) != key:
                gone |= set(range(begin, end))
            own.add(says)
            first.setdefault(says, key)
        if gone:
            drop = {c for i in gone for c in range(*held[i][:2])}
            text = "".join(c for i, c in enumerate(text) if i not in drop)
        result.append(text)
    return result


def encoded(texts):
    """(n_tokens, ids_sha256, decoded_sha256) of each text, from the tokenizers library."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return [
        (len(i), sha(" ".join(map(str, i))), sha(tokenizer.decode(i, skip_special_tokens=False)))
        for i in found
    ]


def token_rows(rows, end=2):
    """(key, start, n_tokens, crc32) of [(key, text)], from the tokenizers library."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, result = 0, []
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        result.append((key, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    return result
