import random

import plain
import pytest

import __spark_entry__ as entry
from oddities import CLASHES, ODD, empty, odd  # noqa: F401
from orderlens.llm import components, simhash


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def test_query_equals_all_pairs(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, plain.fingerprint(r.text)) for r in rows]
    want = plain.components(prints)
    got = entry.queries()["op4_simhash"](spark, small).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {k: f"{f:016x}" for k, f in prints}
    assert {r.doc_id: r.component_id for r in got} == want
    assert any(r.component_id != r.doc_id for r in got)


@pytest.mark.parametrize("crowded", [0, 1, 3, 32])
def test_links_give_the_same_groups(spark, crowded):
    rng = random.Random(crowded)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for f in list(prints)[:20]:  # chains and clusters, in either half and across
        for _ in range(12):
            f ^= 1 << rng.randrange(64)
            f ^= 1 << rng.randrange(64)
            prints.add(f)
    prints |= {(1 << 63) | i for i in range(40)} | {0, (1 << 64) - 1}
    table = spark.createDataFrame([(signed(f),) for f in prints], "f bigint")
    found = components.components(simhash.links(table, crowded)).collect()
    want = plain.components([(signed(f), f) for f in prints])
    roots = {r.node: r.root for r in found}
    assert {k: v for k, v in want.items() if list(want.values()).count(v) > 1} == roots


def test_odd_rows(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by_key = {}
    for r in got:
        by_key.setdefault(r.doc_id, []).append((r.bits, r.component))
    assert by_key[1] == by_key[2] == by_key[3] == [(0, 1)]
    assert by_key[4] == by_key[7] == by_key[8]
    assert len(by_key[5]) == 2 and {c for _, c in by_key[5]} == {5}
    assert {c for b, c in by_key[None] if b == 0} == {1}
    assert {c for b, c in by_key[None] if b != 0} == {None}
    assert simhash.near_duplicates(empty).count() == 0


def test_one_document_of_each_group_stays(odd, empty):
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in rows if r.doc_id in (1, 2, 3, 4, 7, 8)) == [(1, ""), (4, "word")]
    assert [r.doc_id for r in rows].count(5) == 1
    assert all(getattr(r, c) for r in rows for c in CLASHES)
    assert simhash.representatives(empty).count() == 0


def test_components_of_chains_and_odd_links(spark):
    n = 300
    links = [(i, i + 1) for i in range(n)] + [(500, 500), (600, 601), (601, 600), (None, 3), (700, 600)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    got = {r.node: r.root for r in found}
    assert got == {i: 0 for i in range(n + 1)} | {500: 500, 600: 600, 601: 600, 700: 600}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
