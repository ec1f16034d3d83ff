"""The pipeline against its stages without Spark, on a small table and on odd rows."""

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import assert_same, duck
from oddities import PASSAGE
from orderlens.llm import quality
from orderlens.llm.queries import ORACLE_SQL, QUERIES


def plain_run(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judge = quality.fit(quality.count_texts(documents), labels)
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    counts = np.array([quality.statistics(t) for _, t in rows])
    scores = judge.forest.scores(quality.features(counts))
    failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
    rows = [r for r, f, s in zip(rows, failed, scores) if not f and s < judge.threshold]
    groups = plain.components([(k, plain.fingerprint(t)) for k, t in rows])
    rows = [(k, t) for k, t in rows if groups[k] == k]
    left = plain.without_repeats(rows)
    rows = [(k, t) for (k, old), t in zip(rows, left) if t.strip() or t == old]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(k, t) for k, t in rows if not plain.contamination(t, items)[-1]]
    return dict(zip((k for k, _ in rows), plain.encoded([t for _, t in rows])))


def test_run_equals_plain(spark, small):
    got = entry.queries()["pipeline"](spark, small).collect()
    want = plain_run(spark, small)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert 50 < len(got) < 200 and all(len(r.ids) == r.n_tokens for r in got)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    own = [" ".join(f"w{i}x{j}" for j in range(9)) + f" end{i}." for i in range(40)]
    long = [" ".join(own[i : i + 12]) for i in range(0, 36, 12)]
    rows = [(1, long[0]), (2, long[0]), (2, long[0]), (3, f"{long[1]} {PASSAGE}"), (4, f"{long[2]} {PASSAGE}"), (5, None),
            (6, ""), (None, " ".join(own[30:40])), (7, PASSAGE), (8, "benchmark " * 3 + long[2].replace("w", "v"))]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, bits int, contamination string"
    table = spark.createDataFrame([(k, t, None, "s", len(t or ""), "x", 1, None) for k, t in rows], schema)
    table.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    item = long[2].replace("w", "v")[30:200]
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_on_odd_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if stage is not corpus_pipeline.token_ids:
            assert docs.columns == columns
        kept.append(sorted((r.doc_id or 0 for r in docs.collect())))
    # Document 7 is a passage that document 3 holds: nothing of it is left after the third stage.
    assert kept == [[0, 1, 2, 2, 3, 4, 7, 8], [0, 1, 3, 4, 7, 8], [0, 1, 3, 4, 8], [0, 1, 3, 4], [0, 1, 3, 4]]


def test_a_document_that_is_a_passage_of_another_goes(spark, tmp_path):
    tail = "Nine words stand in this sentence here before others. Yes. No. Never."
    rows = [(3, f"{'Something else goes before. ' * 2}{PASSAGE} {tail}"), (7, f"{PASSAGE} {tail}")]
    docs = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id bigint, text string, n_chars bigint")
    assert [r.doc_id for r in corpus_pipeline.without_repeated_spans(spark, docs, str(tmp_path)).collect()] == [3]


def test_a_text_that_stands_in_an_earlier_one_goes(spark, folder):
    """As expected before 8fdbbf7: document 7 is a passage that document 3 holds."""
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        kept.append(sorted(r.doc_id or 0 for r in docs.collect()))
    assert kept[2:] == [[0, 1, 3, 4, 8], [0, 1, 3, 4], [0, 1, 3, 4]]


def test_texts_and_lengths_follow(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id IN (3, 4)")
    rows = {r.doc_id: r for r in corpus_pipeline.without_repeated_spans(spark, docs, folder).collect()}
    assert PASSAGE in rows[3].text and "worth finding" not in rows[4].text
    assert all(r.n_chars == len(r.text) and r.spans == "x" for r in rows.values())


def test_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_sql(spark, small, name):
    with duck(small) as connection:
        for table in ("documents", "pages", "benchmark", "conversations", "labels"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small}/{table}.parquet')")
        assert assert_same(QUERIES[name](spark, small), connection, ORACLE_SQL[name]) > 0


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(ORACLE_SQL) < set(QUERIES)
    assert set(entry.queries()) == {*entry.core_queries(), *QUERIES, "pipeline"}


def test_documents_without_columns_that_are_read_elsewhere(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", F.lit(0).alias("n_chars"))
    assert corpus_pipeline.good_quality(spark, docs, folder).columns == docs.columns
