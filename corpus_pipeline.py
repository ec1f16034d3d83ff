"""From raw documents to token ids: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a table; `run` writes it as Parquet
and reads it again as the next stage's docs.  All but the last keep the columns of
`documents`.  The last gives doc_id, n_tokens, digests of the ids and of the decoded
text, and the ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import bpe, decontamination, quality, simhash, spans
from orderlens.llm.columns import free_name
from orderlens.operators.durable import drop, store

#: No SQL: the isolation forest, XXH64 and the tokenizer have none. The tests compare
#: `run` with a version without Spark.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, the one with the least doc_id."""
    return simhash.representatives(docs)


def without_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of sentences from earlier documents; n_chars follows.

    Documents of which no word is left go.
    """
    name = free_name(docs, "spans")
    found = spans.without_repeats(docs, into=name)
    left = found.withColumns(
        {"text": F.col(f"{name}.text"), "n_chars": F.length(f"{name}.text").cast("bigint")}
    )
    emptied = (F.size(f"{name}.removed") > 0) & (F.col(f"{name}.text").rlike(r"\S") == F.lit(False))
    return left.filter(~emptied).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    name = free_name(docs, "contamination")
    found = decontamination.contamination(docs, benchmark, into=name)
    return found.filter(F.size(f"{name}.hits") == 0).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text."""
    path = public_tokenizers.path("word_bpe_49k.json")
    code = bpe.encoded(F.col("text"), path, with_ids=True)
    return docs.select("doc_id", code.alias("code")).select("doc_id", "code.*")


STAGES = [
    ("quality rules", good_quality),
    ("SimHash near-dedup", without_near_copies),
    ("substring dedup", without_repeated_spans),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored before the next reads it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs, path = store(stage(spark, docs, sf_dir))
        if before:
            drop(spark, before)
        before = path
    return docs
