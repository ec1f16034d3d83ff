import numpy as np
import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from oddities import ODD, empty, odd  # noqa: F401
from orderlens.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expand(symbols, rules, base):
    out = []

    def walk(s):
        if s < base:
            out.append(s)
        else:
            for part in rules[s - base]:
                walk(part)

    for s in symbols:
        walk(int(s))
    return out


def samples():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 50, (30, 6))
    yield np.zeros(0, np.int64)
    yield np.array([7])
    yield np.full(1000, 3)
    yield np.tile([1, 2, 1], 500)
    yield words[rng.zipf(1.5, 3000) % 30].ravel()
    yield rng.integers(0, 50_000, 5000)


@pytest.mark.parametrize("ids", list(samples()))
def test_grammar_gives_back_the_ids(ids):
    symbols, rules = token_files.compress(ids, 50_000)
    assert expand(symbols, rules.tolist(), 50_000) == ids.tolist()
    shard = token_files.Shard(token_files.pack(ids, 50_000))
    assert shard.ids().tolist() == ids.tolist()
    lengths = [len(expand([50_000 + i], rules.tolist(), 50_000)) for i in range(len(rules))]
    assert shard.lengths.tolist() == lengths
    rng = np.random.default_rng(len(ids))
    for start in rng.integers(0, len(ids) + 1, 40).tolist():
        count = int(rng.integers(0, len(ids) - start + 1))
        assert shard.ids(start, count).tolist() == ids[start : start + count].tolist()


def test_frequent_pairs_are_replaced():
    ids = np.tile(np.arange(8), 4000)
    symbols, rules = token_files.compress(ids, 100)
    assert len(rules) and len(symbols) < len(ids) / 8
    assert len(token_files.pack(ids, 100)) < 4 * len(ids) / 10
    pairs = list(zip(rules[:, 0].tolist(), rules[:, 1].tolist()))
    assert len(set(pairs)) == len(pairs)


def equal_documents():
    """A shard of many equal documents, one of copies with changes, and one of a single id."""
    rng = np.random.default_rng(4)
    one = rng.integers(0, 50_000, 700)
    changed = np.tile(one, 300)
    changed[rng.integers(0, len(changed), 2000)] = 7
    yield np.tile(one, 700)
    yield changed
    yield np.full(200_001, 9)
    yield rng.integers(0, 50_000, 400_000) // 100


@pytest.mark.parametrize("ids", list(equal_documents()))
def test_no_frequent_pair_is_left(ids):
    symbols, rules = token_files.compress(ids, 50_258)
    keys, counts = np.unique(symbols[:-1] << 32 | symbols[1:], return_counts=True)
    assert not (counts >= token_files.LEAST_COUNT).any()
    shard = token_files.Shard(token_files.pack(ids, 50_258))
    assert (shard.ids() == ids).all() and (shard.ids(4321, 1234) == ids[4321:5555]).all()


def test_copies_become_long_rules():
    copies, changed, single, _ = (token_files.Shard(token_files.pack(ids, 50_258)) for ids in equal_documents())
    assert copies.lengths.max() > 64 and single.lengths.max() > 4096 and changed.lengths.max() > 16
    assert len(copies.symbols) < 900 and len(single.symbols) < 900


def test_rules_beyond_16_bits():
    """More rules than 16 bits can name: pairs are kept in 64 bits from then on."""
    ids = np.repeat(np.random.default_rng(6).integers(0, 60_000, 2 * 9000).reshape(-1, 2), 8, axis=0).ravel()
    symbols, rules = token_files.compress(ids, 60_000)
    assert 60_000 + len(rules) > 1 << 16
    assert expand(symbols, rules.tolist(), 60_000) == ids.tolist()
    assert (token_files.Shard(token_files.pack(ids, 60_000)).ids() == ids).all()


def test_many_symbols_take_32_bits():
    ids = np.tile(np.arange(65_520, 65_536), 400)
    content = token_files.pack(ids, 65_536)
    shard = token_files.Shard(content)
    assert shard.symbols.dtype == np.uint32 and shard.ids().tolist() == ids.tolist()


@pytest.mark.parametrize("spoil", [lambda c: c[:-1], lambda c: c + b"x", lambda c: b"nope" + c[4:]])
def test_spoilt_shards_are_refused(spoil):
    with pytest.raises(ValueError):
        token_files.Shard(spoil(token_files.pack(np.arange(500) % 9, 50)))


def test_chunks_are_encoded_as_in_the_text():
    encoder, library = token_files.ChunkEncoder(PATH, remembered=16), Tokenizer.from_file(PATH)
    texts = ["a\nb", "a\n b", " a b", "a  b", "a\n\nb", "a b\n", "a\x00b c", "<|endoftext|> a", "I'll don't\n'tis 12 3",
             "a\tb", "\n", "a é b c", "x" * 4000, "word " * 200, "\xa0a\xa0b", " \x85 a", "a b c", None, ""]
    texts += ["end.", "a, b. c", "a., b", "a_, b", "(a), b", "a... b", "é, ü. 5, x", ",", "a ,b . c", "½. ², x", "a.\nb,\nc"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for one in (texts, texts[::-1]):
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(one)]
        assert got == (want if one is texts else want[::-1])
    assert [np.frombuffer(encoder.encode([t])[0], "<u4").tolist() for t in texts] == want


@pytest.mark.parametrize("remembered", [16, 300, 100_000])
def test_many_different_chunks(remembered):
    encoder, library = token_files.ChunkEncoder(PATH, remembered=remembered), Tokenizer.from_file(PATH)
    rng = np.random.default_rng(remembered)
    letters = "abcdeéñ.,"
    words = ["".join(letters[i] for i in rng.integers(0, 9, rng.integers(1, 30))) for _ in range(3000)]
    texts = [" ".join(words[:2000]), *("\n".join(words[i : i + 40]) for i in range(0, 3000, 40)), " ".join(words[::-1])]
    for _ in range(2):
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("shard_ids", [1, 3000, token_files.SHARD_IDS])
def test_odd_rows(odd, shard_ids):
    shards = token_files.write_shards(odd, PATH, shard_ids=shard_ids)
    got = token_files.read_documents(shards, with_ids=True).orderBy("start").collect()
    rows = odd.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h, r.text or ""))
    want = plain.token_rows([(r.doc_id, r.text) for r in rows])
    assert [tuple(r)[:4] for r in got] == want and len(got) == len(ODD)
    assert all(len(r.ids) == r.n_tokens and r.ids[-1] == token_files.END_ID for r in got)


def test_empty_table(empty):
    assert token_files.read_documents(token_files.write_shards(empty, PATH)).count() == 0


def test_query_equals_the_library(spark, small):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    got = entry.queries()["op7_repair"](spark, small).collect()
    assert sorted(map(tuple, got)) == plain.token_rows(rows)
