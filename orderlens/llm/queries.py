"""The queries of this subpackage over the test tables, and SQL for some of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    bpe,
    decontamination,
    filter_audit,
    harmonic_packing,
    pseudo_likelihood,
    quality,
    simhash,
    spans,
    term_search,
    token_files,
    tool_calls,
    toxicity,
    warc,
)
from orderlens.operators.durable import store


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    code = bpe.encoded(F.col("text"), public_tokenizers.path("word_bpe_49k.json"))
    return _table(spark, folder, "documents").select("doc_id", code.alias("code")).select(
        "doc_id", "code.*"
    )


def op2_spans(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return spans.without_repeats(documents).select("doc_id", "spans.*")


#: Parameters of the two calls that plain conversations are read as.
CHAT_TOOLS = [
    ("reply", "text", "string", True),
    ("reply", "turn", "integer", True),
    ("reply", "words", "integer", True),
    ("configure", "text", "string", True),
]


def faulty_calls(calls: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of `turns_as_calls`, with a fault by conv_id % 11 in `reply` calls.

    1: a turn needs the user turn after it, 2: pairs of turns need each other, 3: `words` is
    a text, 4: no `text`, 5: a parameter `hint`, 6: needs a call that does not exist, 7: turns
    also answer the call three before them, 8: the last character of the arguments is cut off,
    9: the tool has another name, 10: each call is there again under another name, 0: none.
    """
    rule, turn = F.when(F.col("name") == "reply", F.col("conv_id") % 11), F.col("position")

    def call(at: Column | str) -> Column:
        return F.concat_ws("-", F.col("conv_id").cast("string"), F.lit(at) if isinstance(at, str) else at.cast("string"))

    other = turn + F.when(rule == 1, 2).when(rule == 2, F.when(turn % 4 < 2, 2).otherwise(-2))
    present = calls.filter("name = 'reply'").select("conv_id", F.col("position").alias("_other"), F.lit(True).alias("_there")).distinct()
    given = F.from_json("arguments", "turn bigint, words bigint, text string")
    named = [F.col(f"_given.{n}").alias(n) for n in ("turn", "words", "text")]
    arguments = (
        F.when(rule == 3, F.to_json(F.struct(named[0], named[1].cast("string").alias("words"), named[2])))
        .when(rule == 4, F.to_json(F.struct(*named[:2])))
        .when(rule == 5, F.to_json(F.struct(*named, F.lit(True).alias("hint"))))
        .when(rule == 8, F.expr("left(arguments, length(arguments) - 1)"))
        .otherwise(F.col("arguments"))
    )
    none = F.array().cast("array<string>")
    needs = (
        F.when(rule.isin(1, 2), F.when(F.col("_there"), F.array(call(F.col("_other")))).otherwise(none))
        .when(rule == 6, F.concat("depends_on", F.array(call("none"))))
        .otherwise(F.col("depends_on"))
    )
    names = (
        F.when(rule == 9, F.array(F.lit("respond")))
        .when(rule == 10, F.array(F.lit("reply"), F.lit("reply_again"))).otherwise(F.array("name"))
    )
    told = calls.withColumn("_other", other).join(present, ["conv_id", "_other"], "left").withColumn("_given", given)
    told = told.select("conv_id", "call_id", "position", F.explode(names).alias("name"), arguments.alias("arguments"), needs.alias("depends_on"))
    earlier = F.regexp_extract("call_id", "^[^-]*-(-?[0-9]+)$", 1).cast("bigint") - 2
    targets = F.when(F.col("conv_id") % 11 == 7, F.array(F.col("call_id"), call(earlier))).otherwise(F.array("call_id"))
    return told, results.select("conv_id", F.explode(targets).alias("call_id"), "content")


def op3_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Plain conversations as calls, with faults by rule, written as JSON turns and read from those."""
    turns = tool_calls.text_of_calls(*faulty_calls(*tool_calls.turns_as_calls(_table(spark, folder, "conversations"))))
    calls, results = tool_calls.calls_in_text(turns)
    schemas = spark.range(1).select(
        F.inline(F.array(*[F.struct(*map(F.lit, tool)) for tool in CHAT_TOOLS]))
    ).toDF("name", "parameter", "kind", "required")
    found = tool_calls.whole(calls, results, schemas)
    return found.withColumn("errors", F.array_join("errors", "; ")).withColumn("position", F.col("position.turn"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op5_isolation_forest(spark: SparkSession, folder: str) -> DataFrame:
    counted = quality.count_texts(_table(spark, folder, "documents"))
    judge = quality.fit(counted, _table(spark, folder, "labels"))
    return quality.judged(counted, judge).select(
        "doc_id", *[f"counts.{name}" for name in quality.COUNTS[:5]], "base_failed", "kept", "score"
    )


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(
        _table(spark, folder, "documents").select("doc_id", "text"),
        _table(spark, folder, "benchmark"),
    )
    return found.select("doc_id", *contamination_digest("contamination"))


def contamination_digest(column: str) -> list:
    n_hit = decontamination.hit_words(f"{column}.hits")
    return [
        F.col(f"{column}.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(f"{column}.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", f"{column}.items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    ]


def op7_repair(spark: SparkSession, folder: str) -> DataFrame:
    shards = token_files.write_shards(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return token_files.read_documents(shards)


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    digest, first = warc.first_copy_names(pages)
    marked = warc.with_first_copies(pages, "html", "page_id", digest, first)
    written, _ = store(warc.archives(marked, "html", "page_id", "url", digest, first))
    key = pages.schema["page_id"].dataType.simpleString()
    return warc.records(written, payloads=False).select(
        warc.key_of("record_id", key).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.key_of("refers_to", key).alias("refers_to"),
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    model = toxicity.fit(documents, _table(spark, folder, "labels"))
    scores = documents.select(
        "doc_id",
        (toxicity.fold("doc_id") == 0).alias("held_out"),
        toxicity.score(model, F.col("text")).alias("score"),
    )
    return scores.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood.score_all(_table(spark, folder, "documents"))


def op11_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return harmonic_packing.packed(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    found = filter_audit.cells(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return filter_audit.audited(found)


def op13_term_search(spark: SparkSession, folder: str) -> DataFrame:
    return term_search.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_spans": op2_spans,
    "op3_tool_calls": op3_tool_calls,
    "op4_simhash": op4_simhash,
    "op5_isolation_forest": op5_isolation_forest,
    "op6_decontamination": op6_decontamination,
    "op7_repair": op7_repair,
    "op8_warc": op8_warc,
    "op9_toxicity": op9_toxicity,
    "op10_pseudo_likelihood": op10_pseudo_likelihood,
    "op11_harmonic_packing": op11_harmonic_packing,
    "op12_filter_audit": op12_filter_audit,
    "op13_term_search": op13_term_search,
}

_DOC_WORDS = """
    SELECT {key}, list_filter(
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'),
                           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words
    FROM {table}"""

ORACLE_SQL: dict[str, str] = {
    "op3_tool_calls": r"""
        WITH RECURSIVE t AS (
            SELECT conv_id, turn, lower(role) AS role, text, conv_id % 11 AS rule,
                   len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda w: w <> '')) AS words
            FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
        ), asked AS (SELECT conv_id, turn FROM t WHERE role = 'user'),
        chain AS (
            SELECT conv_id, turn, 0 AS level FROM asked AS a
            WHERE conv_id % 11 = 1
              AND NOT EXISTS (FROM asked AS b WHERE b.conv_id = a.conv_id AND b.turn = a.turn + 2)
            UNION ALL
            SELECT a.conv_id, a.turn, level + 1 FROM asked AS a
            JOIN chain AS c ON c.conv_id = a.conv_id AND c.turn = a.turn + 2
        ), calls AS (
            SELECT t.conv_id, t.conv_id || '-' || t.turn AS call_id, t.turn AS position,
                   CASE WHEN role = 'system' THEN 'configure' WHEN rule = 9 THEN 'respond' ELSE 'reply' END AS name,
                   CASE WHEN role = 'system' THEN to_json(struct_pack(text := text))
                        WHEN rule = 3 THEN to_json(struct_pack(text := text, turn := t.turn, words := words::VARCHAR))
                        WHEN rule = 4 THEN to_json(struct_pack(turn := t.turn, words := words))
                        WHEN rule = 5 THEN to_json(struct_pack(hint := true, text := text, turn := t.turn, words := words))
                        WHEN rule <> 8 THEN to_json(struct_pack(text := text, turn := t.turn, words := words))
                        END AS arguments,
                   CASE WHEN role = 'user' AND rule = 8 THEN
                        left(CAST(to_json(struct_pack(turn := t.turn, words := words, text := text)) AS VARCHAR), -1)
                        END AS unparsed,
                   CASE WHEN role = 'system' THEN NULL WHEN rule = 3 THEN 'wrong type: words' WHEN rule = 4 THEN 'missing: text'
                        WHEN rule = 5 THEN 'unknown: hint' WHEN rule = 8 THEN 'malformed' WHEN rule = 9 THEN 'unknown tool'
                        END AS error,
                   CASE WHEN role = 'system' THEN 0 WHEN rule = 1 THEN c.level WHEN rule = 2 AND p.turn IS NOT NULL THEN NULL ELSE 0 END AS level,
                   role = 'system' OR NOT (rule = 6 OR rule = 2 AND p.turn IS NOT NULL) AS orderly,
                   role = 'user' AND rule = 10 AS twice
            FROM t
            LEFT JOIN chain AS c ON role = 'user' AND c.conv_id = t.conv_id AND c.turn = t.turn
            LEFT JOIN asked AS p ON role = 'user' AND p.conv_id = t.conv_id
                                    AND p.turn = t.turn + CASE WHEN t.turn % 4 < 2 THEN 2 ELSE -2 END
            WHERE role IN ('user', 'system')
        ), told AS (
            SELECT conv_id, unnest(CASE WHEN rule = 7 THEN [turn - 1, turn - 3] ELSE [turn - 1] END) AS position, text
            FROM t WHERE role IS NULL OR role NOT IN ('user', 'system')
        ), texts AS (
            SELECT conv_id, position, text, count(*) AS copies FROM told GROUP BY ALL
        ), answers AS (
            SELECT conv_id, position, min(text) AS result, CAST(sum(copies) AS BIGINT) AS answers FROM texts GROUP BY ALL
        ), shown AS (
            SELECT conv_id, call_id, position, level, name, arguments, unparsed,
                   CASE WHEN error IS NULL THEN CAST([] AS VARCHAR[]) ELSE [error] END AS errors,
                   error IS NULL AND orderly AS valid, coalesce(answers, 0) AS answers, result, CAST(NULL AS BIGINT) AS copies
            FROM calls LEFT JOIN answers USING (conv_id, position)
            UNION ALL
            SELECT conv_id, call_id, position, NULL, 'reply_again', NULL,
                   CAST(to_json(struct_pack(turn := position, words := arguments->'$.words', text := arguments->'$.text')) AS VARCHAR),
                   ['conflicting call'], false, NULL, NULL, 1
            FROM calls WHERE twice
            UNION ALL
            SELECT x.conv_id, x.conv_id || '-' || x.position, NULL, NULL, NULL, NULL, NULL,
                   [CASE WHEN c.call_id IS NULL THEN 'result without a call' ELSE 'further result' END], false, NULL, text, copies
            FROM texts AS x JOIN answers USING (conv_id, position) LEFT JOIN calls AS c USING (conv_id, position)
            WHERE c.call_id IS NULL OR text IS DISTINCT FROM answers.result
        )
        SELECT conv_id, call_id, position, CAST(level AS INTEGER) AS level, name,
               CAST(arguments AS VARCHAR) AS arguments, unparsed, array_to_string(errors, '; ') AS errors,
               valid, answers, result, copies,
               CAST(to_json(struct_pack(
                   arguments := coalesce(arguments, to_json(unparsed)), call_id := call_id, conv_id := conv_id,
                   errors := errors, name := name, result := result)) AS VARCHAR) AS record
        FROM shown""",
    "op6_decontamination": f"""
        WITH d AS ({_DOC_WORDS.format(key="doc_id", table="documents")}),
        i AS ({_DOC_WORDS.format(key="item_id", table="benchmark")}),
        windows AS (
            SELECT DISTINCT item_id, list_slice(words, first, first + n - 1) AS w, n
            FROM (SELECT *, least(10, len(words)) AS n FROM i WHERE len(words) > 0),
                 unnest(range(1, len(words) - n + 2)) AS s(first)
        ), places AS (
            SELECT doc_id, first, n, list_slice(words, first, first + n - 1) AS w
            FROM d, (SELECT DISTINCT n FROM windows), unnest(range(1, len(words) - n + 2)) AS s(first)
        ), met AS (SELECT doc_id, item_id, first, n FROM places JOIN windows USING (w, n)),
        hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM met, unnest(range(first, first + n)) AS u(p) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
        ), d AS (
            SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest
            FROM p
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN
                       min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
            FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id IS NOT NULL AND first_id IS DISTINCT FROM page_id
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
        FROM f""",
    "op12_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents
        ), said AS (
            SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad
            FROM labels GROUP BY doc_id
        ), judged AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
                   CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
                   || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
                   || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t)
                      THEN 'C' ELSE '' END
                   || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                   || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
            FROM d LEFT JOIN said USING (doc_id)
        ), cells AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM judged GROUP BY ALL
        ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), steps AS (SELECT filter_order, s AS step, filter_order[s] AS f, filter_order[:s - 1] AS before
                     FROM orders, range(1, 6) AS r(s)),
        met AS (
            SELECT *, contains(fails, f) AS failing,
                   translate(fails, before, '') <> fails AS gone
            FROM cells, steps
        ), counted AS (
            SELECT part, filter_order, CAST(step AS INTEGER) AS step, f,
                   CAST(coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS BIGINT) AS kept,
                   CAST(coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS BIGINT) AS removed,
                   CAST(coalesce(sum(n) FILTER (gone AND failing), 0) AS BIGINT) AS redundant,
                   CAST(coalesce(sum(n) FILTER (fails = f), 0) AS BIGINT) AS unique_fails,
                   CAST(coalesce(sum(good) FILTER (NOT gone AND failing), 0) AS BIGINT) AS good_lost,
                   CAST(coalesce(sum(bad) FILTER (NOT gone AND failing), 0) AS BIGINT) AS toxic_lost
            FROM met GROUP BY ALL
        )
        SELECT * EXCLUDE (f), CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
        FROM counted""",
    "op13_term_search": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS row_id, unnest(list_filter(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '')) AS term
            FROM documents
        ), wanted AS (
            SELECT DISTINCT item_id, unnest(list_filter(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '')) AS term
            FROM benchmark
        ), counts AS (SELECT row_id, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
        lengths AS (SELECT row_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY row_id),
        totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM lengths),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
        ), scored AS (
            SELECT item_id, row_id, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nd) // l)))) AS BIGINT) AS score
            FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (row_id), totals
            GROUP BY item_id, row_id, doc_id
        ), ranks AS (
            SELECT item_id, CAST(row_number() OVER (
                       PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 50""",
}
