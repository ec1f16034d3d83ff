import random

import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from oddities import ODD, empty, odd  # noqa: F401
from orderlens.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def same(encoder, library, texts):
    found = library.encode_batch(texts, add_special_tokens=False)
    assert [i.tolist() for i in encoder.encode(texts)] == [e.ids for e in found]


def test_query_equals_the_library(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(rows, plain.encoded([r.text for r in rows]))}
    got = entry.queries()["op1_bpe"](spark, small).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_odd_texts(odd, empty):
    code = bpe.encoded(F.col("text"), PATH, with_ids=True, remembered=40).alias("r")
    got = odd.select("text", code).collect()
    want = plain.encoded([r.text for r in got])
    assert [(r.r.n_tokens, r.r.ids_sha256, r.r.decoded_sha256) for r in got] == want
    assert all(len(r.r.ids) == r.r.n_tokens for r in got)
    assert len(got) == len(ODD)
    assert empty.select(code).count() == 0


def test_characters_of_many_scripts(encoder, library):
    points = [*range(0x20, 0x600), *range(0x900, 0xA00), *range(0x1E00, 0x2100), *range(0x3000, 0x3100), *range(0xFB00, 0xFB50)]
    same(encoder, library, [f"a{chr(c)}b {chr(c)} A{chr(c)}́x" for c in points])


@pytest.mark.parametrize("alphabet", ["ab", "aab<", "the ", "aé́Σς ", "0123 .,!'"])
def test_random_texts(encoder, library, alphabet):
    rng = random.Random(alphabet)
    same(encoder, library, ["".join(rng.choice(alphabet) for _ in range(rng.randrange(400))) for _ in range(60)])


def test_fragments_without_blanks(encoder, library):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    same(encoder, library, [long, "x" * 5000, "ab" * 3000, long[:65], long[:64], long[:63]])


def test_cuts_are_where_no_token_reaches_across(encoder):
    vocabulary = encoder.vocabulary
    letters = {c: b for b, c in bpe.byte_alphabet().items()}
    assert 0 < vocabulary.together.sum() < vocabulary.together.size
    for token in vocabulary.tokens[512:3000]:
        raw = [letters[c] for c in token.removesuffix(bpe.WORD_END)]
        assert all(
            vocabulary.together[a, b] or vocabulary.together[a, 256 + b] for a, b in zip(raw, raw[1:])
        )


def test_little_memory_gives_the_same(encoder, spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    few = bpe.Encoder(PATH, remembered=8)
    assert [i.tolist() for t in texts for i in few.encode([t])] == [i.tolist() for i in encoder.encode(texts)]
