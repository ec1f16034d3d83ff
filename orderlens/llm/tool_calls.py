"""Chat formatting: link tool calls to their results, order and check them.

DataFrame and SQL functions only.  Calls and results are joined by identifier;
arguments are parsed as variants, checked against the parameters of their tool, and
written as canonical JSON: no blanks, keys in order.

Tables (further columns are not read):
* calls: conv_id, call_id, position, name, arguments (JSON text), depends_on (ids of calls)
* results: conv_id, call_id, content
* schemas: name, parameter, kind, required

`position` says where a call stands in its conversation: anything that can be compared.

`formatted` gives a row per call; `leftover` a row with an error for whatever has no place in
those: further results of a call, results without a call, calls that repeat an id otherwise,
calls without an id.  `whole` is both, in which no text is lost.  Nulls are values like any
other in contents; empty tables give empty results; texts are carried as they are, however
long; further columns, also of the same names as columns of the result, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.durable import drop, store

KEY = ["conv_id", "call_id"]
_REST = ["position", "name", "arguments", "depends_on"]

#: Parameters of all tools that are broadcast; more are joined by a shuffle.
BROADCAST_PARAMETERS = 100_000

# JSON Schema's names of types, and what values of a type look like.
_KINDS = {
    "integer": "BIGINT|DECIMAL\\([0-9]+,0\\)", "number": "BIGINT|DOUBLE|DECIMAL.*", "string": "STRING",
    "boolean": "BOOLEAN", "object": "OBJECT<.*", "array": "ARRAY<.*", "null": "VOID",
}


def distinct_calls(calls: DataFrame) -> DataFrame:
    """One row per call: repeated ids keep the least row, and count the others.

    Calls without an id or a conversation can't be linked and are left out.
    """
    least = F.min(F.struct(*_REST)).alias("_least")
    found = calls.dropna(subset=KEY).groupBy(*KEY).agg(least, F.count(F.lit(1)).alias("copies"))
    return found.select(*KEY, "_least.*", "copies")


def linked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls (one per id) with `result` and `answers`, the number of results.

    Of several results the least text is taken; `leftover` has the others.  A call without
    a result has none; a result without a call has no place here, see `leftover`.
    """
    answers = results.dropna(subset=KEY).groupBy(*KEY).agg(
        F.min("content").alias("result"), F.count(F.lit(1)).alias("answers")
    )
    return calls.join(answers, KEY, "left").withColumn("answers", F.coalesce("answers", F.lit(0)))


def unclaimed(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose call does not exist."""
    return results.join(calls.select(*KEY), KEY, "left_anti")


def leftover(calls: DataFrame, results: DataFrame) -> DataFrame:
    """What `linked` has no place for: rows (conv_id, call_id, position, name, arguments,
    depends_on, result, error, copies).

    Errors: `call without an id`, `conflicting call` (an id given again, with anything
    else), `result without a call`, `further result` (any text but the least).  Equal rows
    are one row with their number.  Rows are grouped with their whole content, so that no
    task gets all rows of one id.
    """
    # The derived column keeps Spark from reusing the grouping for the join, so that adaptive
    # execution can split an id with very many rows.
    part = F.xxhash64(*KEY).alias("_part")
    given = calls.groupBy(*KEY, *_REST).agg(F.count(F.lit(1)).alias("copies"))
    first = calls.dropna(subset=KEY).groupBy(*KEY, part).agg(F.min(F.struct(*_REST)).alias("_least")).drop("_part")
    conflicts = (
        given.join(first, KEY, "left").filter(~F.col("_least").eqNullSafe(F.struct(*_REST)))
        .withColumn("error", F.when(F.col("_least").isNull(), "call without an id").otherwise("conflicting call"))
        .select(*KEY, *_REST, F.lit(None).cast("string").alias("result"), "error", "copies")
    )
    answers = results.groupBy(*KEY, F.col("content").alias("result")).agg(F.count(F.lit(1)).alias("copies"))
    both = calls.select(*KEY, F.lit(None).cast("string").alias("content"), F.lit(True).alias("asked")).unionByName(
        results.select(*KEY, "content", F.lit(False).alias("asked"))
    )
    known = both.dropna(subset=KEY).groupBy(*KEY, part).agg(
        F.max("asked").alias("_asked"), F.struct(F.min("content").alias("result")).alias("_taken")
    ).filter("_asked").drop("_part", "_asked")
    unplaced = (
        answers.join(known, KEY, "left").filter(~F.col("_taken").eqNullSafe(F.struct("result")))
        .withColumn("error", F.when(F.col("_taken").isNull(), "result without a call").otherwise("further result"))
    )
    types = calls.schema
    return conflicts.unionByName(
        unplaced.select(
            *KEY, *[F.lit(None).cast(types[c].dataType).alias(c) for c in _REST], "result", "error", "copies"
        )
    )


def dependencies(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, position, needs, needed_at): a row per dependency.

    `needed_at` is null if the call asked for does not exist.
    """
    edges = calls.select(*KEY, "position", F.explode(F.array_distinct("depends_on")).alias("needs"))
    places = calls.select("conv_id", F.col("call_id").alias("needs"), F.col("position").alias("needed_at"))
    return edges.dropna(subset=["needs"]).join(places, ["conv_id", "needs"], "left")


def ordered(calls: DataFrame) -> DataFrame:
    """`calls` with `level`, `dangling` and `cyclic`: (level, position) is a topological order.

    Where every call comes after those it needs, the position is an order already and
    the level 0.  Only conversations in which some call needs a later one are levelled: a
    call has the greatest level of its needs, or one more if that call stands later.  Chains
    of calls with one need are followed by doubling, calls with several needs round by round,
    each a stored table.  Calls on a cycle, or that need one, keep a null level and are `cyclic`.  A need that does not exist counts as
    `dangling` and orders nothing.  Runs a job to look for such conversations.
    """
    needs, _ = store(dependencies(calls))
    dangling = needs.filter("needed_at IS NULL").groupBy(*KEY).agg(F.count(F.lit(1)).alias("dangling"))
    counted = calls.join(dangling, KEY, "left").withColumn("dangling", F.coalesce("dangling", F.lit(0)))
    spark = calls.sparkSession
    late, late_path = store(needs.filter("needed_at >= position").select("conv_id").distinct())
    if late.isEmpty():
        drop(spark, late_path)
        return counted.withColumns({"level": F.lit(0).cast("int"), "cyclic": F.lit(False)})
    edges, edges_path = store(
        needs.filter("needed_at IS NOT NULL").join(late, "conv_id", "left_semi")
        .withColumn("more", (F.col("needed_at") >= F.col("position")).cast("int"))
        .select(*KEY, "needs", "more")
    )
    nodes, _ = store(calls.join(late, "conv_id", "left_semi").select(*KEY))
    drop(spark, late_path)
    chains = _chains(edges)
    done = _levels(nodes, edges, chains)
    drop(spark, edges_path)
    end = done.select("conv_id", F.col("call_id").alias("at"), F.col("level").alias("_at"))
    along = chains.join(end, ["conv_id", "at"]).select(*KEY, (F.col("_at") + F.col("dist")).cast("int").alias("level"))
    done = done.unionByName(along)
    levelled = nodes.join(done, KEY, "left").withColumn("_levelled", F.lit(True))
    result = counted.join(levelled, KEY, "left")
    level = F.when(F.col("_levelled").isNull(), F.lit(0)).otherwise(F.col("level"))
    return result.withColumn("level", level).withColumn("cyclic", F.col("level").isNull()).drop("_levelled")


def _chains(edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, at, dist) of calls with one need: the first call along their needs
    that has none or several, and the steps to it.

    The level of a call with one need is that of the need plus the step, so whole chains are
    followed by doubling: as many rounds as the greatest number of such calls in a
    conversation has binary digits.  Calls whose chain runs into a cycle keep an `at` that is
    itself such a call.
    """
    spark = edges.sparkSession
    single = edges.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_needs"), F.min("needs").alias("at"), F.min("more").cast("bigint").alias("dist")
    ).filter("_needs = 1").drop("_needs")
    chains, path = store(single)
    most = chains.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(most.bit_length()):
        onward = chains.select(
            "conv_id", F.col("call_id").alias("at"), F.col("at").alias("_at"), F.col("dist").alias("_dist")
        )
        following, new_path = store(chains.join(onward, ["conv_id", "at"], "left").select(
            *KEY, F.coalesce("_at", "at").alias("at"), (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist")
        ))
        drop(spark, path)
        chains, path = following, new_path
    return chains


def _levels(nodes: DataFrame, edges: DataFrame, chains: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls that need none or several; not of those on a cycle.

    Needs lead past chains to where these end.  Round by round, calls whose needs all have a
    level get one: as many rounds as calls with several needs follow each other.
    """
    spark = nodes.sparkSession
    done, path = store(
        nodes.join(edges.select(*KEY).distinct(), KEY, "left_anti").withColumn("level", F.lit(0).cast("int"))
    )
    several = edges.join(chains.select(*KEY), KEY, "left_anti")
    ends = chains.select("conv_id", F.col("call_id").alias("needs"), "at", "dist")
    needs, needs_path = store(several.join(ends, ["conv_id", "needs"], "left").select(
        *KEY, F.coalesce("at", "needs").alias("needs"), (F.col("more") + F.coalesce("dist", F.lit(0))).alias("more")
    ))
    if needs.isEmpty():
        drop(spark, needs_path)
        return done
    size = done.count()
    while True:
        source = done.select("conv_id", F.col("call_id").alias("needs"), F.col("level").alias("_at"))
        reached = needs.join(source, ["conv_id", "needs"], "left").groupBy(*KEY).agg(
            F.max(F.col("_at") + F.col("more")).alias("level"), F.count_if(F.col("_at").isNull()).alias("_open")
        )
        following, new_path = store(
            done.join(needs.select(*KEY).distinct(), KEY, "left_anti")
            .unionByName(reached.filter("_open = 0").select(*KEY, F.col("level").cast("int").alias("level")))
        )
        grown = following.count()
        drop(spark, path)
        done, path = following, new_path
        if grown == size:
            drop(spark, needs_path)
            return done
        size = grown


def checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """`calls` with canonical `arguments`, `unparsed` and sorted `errors`.

    Errors: `malformed` (no JSON object, or a key twice; the arguments are then null, and
    their text is in `unparsed`),
    `unknown tool`, and `missing`, `unknown` and `wrong type` with the parameter.  A
    call of an unknown tool has no other error.  Parameters given twice for a tool
    take the least kind.
    """
    rows = schemas.dropna(subset=["name", "parameter"]).groupBy("name", "parameter").agg(
        F.min("kind").alias("kind"), F.max(F.coalesce("required", F.lit(False))).alias("required")
    )
    tools = rows.groupBy("name").agg(
        F.map_from_entries(F.collect_list(F.struct("parameter", F.struct("kind", "required")))).alias("_parameters")
    )
    if rows.count() <= BROADCAST_PARAMETERS:
        tools = F.broadcast(tools)
    parsed = F.try_parse_json(F.coalesce("arguments", F.lit("{}")))
    values = F.expr("try_variant_get(_parsed, '$', 'map<string, variant>')")
    joined = calls.withColumn("_parsed", parsed).withColumn("_values", values).join(tools, "name", "left")
    good = F.when(F.col("_values").isNotNull(), F.col("_parsed"))
    errors = (
        F.when(F.col("_values").isNull(), F.array(F.lit("malformed")))
        .when(F.col("_parameters").isNull(), F.array(F.lit("unknown tool")))
        .otherwise(F.array_sort(F.concat(_missing(), _unknown(), _wrong())))
    )
    return (
        joined.withColumn("errors", errors).withColumn("_good", good)
        .withColumn("unparsed", F.when(F.col("_values").isNull(), F.col("arguments")))
        .withColumn("arguments", F.to_json("_good"))
       .drop("_parsed", "_values", "_parameters")
    )


def _missing() -> Column:
    return F.expr(
        "transform(filter(map_entries(_parameters), e -> e.value.required AND NOT "
        "map_contains_key(_values, e.key)), e -> concat('missing: ', e.key))"
    )


def _unknown() -> Column:
    return F.expr(
        "transform(filter(map_keys(_values), k -> NOT map_contains_key(_parameters, k)), k -> concat('unknown: ', k))"
    )


def _wrong() -> Column:
    kinds = " ".join(f"WHEN '{kind}' THEN r'^({pattern})$'" for kind, pattern in _KINDS.items())
    return F.expr(
        f"""transform(
            filter(map_entries(_values), e -> map_contains_key(_parameters, e.key) AND NOT
                   schema_of_variant(e.value) RLIKE (CASE _parameters[e.key].kind {kinds} ELSE '.*' END)),
            e -> concat('wrong type: ', e.key))"""
    )


def formatted(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call: linked, ordered, checked, and as a canonical JSON `record`.

    Columns: conv_id, call_id, position, level, name, arguments, unparsed, errors, valid,
    answers, result, record.  A call is valid if it has no errors, hangs on nothing that does
    not exist, and is on no cycle.  Arguments that are no JSON object are a text in the
    record.  Empty tables give an empty result.
    """
    unique, _ = store(distinct_calls(calls))
    found = checked(linked(ordered(unique), results), schemas)
    valid = (F.size("errors") == 0) & (F.col("dangling") == 0) & ~F.col("cyclic")
    record = _record(F.coalesce("_good", F.col("unparsed").cast("variant")))
    return found.withColumn("valid", valid).select(
        "conv_id", "call_id", "position", "level", "name", "arguments", "unparsed", "errors", "valid",
        "answers", "result", record.alias("record"),
    )


def _record(arguments: Column) -> Column:
    fields = F.struct(arguments.alias("arguments"), "call_id", "conv_id", "errors", "name", "result")
    return F.to_json(fields, {"ignoreNullFields": "false"})


def whole(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """`formatted` and `leftover` rows, the latter with their error, no level, and invalid.

    `copies` counts the equal rows that a leftover row stands for; it is null for calls.
    Calls and results are stored first: they are read eight times, and may come from
    parsing and joins.
    """
    calls, _ = store(calls.select(*KEY, *_REST))
    results, _ = store(results.select(*KEY, "content"))
    rest = leftover(calls, results).withColumn("errors", F.array("error")).withColumn("unparsed", F.col("arguments"))
    given = rest.select(
        "conv_id", "call_id", "position", F.lit(None).cast("int").alias("level"), "name",
        F.lit(None).cast("string").alias("arguments"), "unparsed", "errors", F.lit(False).alias("valid"),
        F.lit(None).cast("bigint").alias("answers"), "result",
        _record(F.col("unparsed").cast("variant")).alias("record"), "copies",
    )
    return formatted(calls, results, schemas).withColumn("copies", F.lit(None).cast("bigint")).unionByName(given)


def calls_in_text(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from turns whose text is JSON.

    A call turn is {"tool_calls": [{"id", "name", "arguments", "depends_on"}]}, a result
    turn {"tool_call_id", "content"}.  Arguments are an object, or a text that should hold
    one.  Turns that are neither hold no calls.  A call's position is its (turn, at).
    """
    parsed = conversations.select("conv_id", F.col("turn").cast("bigint"), F.try_parse_json("text").alias("v"))
    many = F.expr(
        "try_variant_get(v, '$.tool_calls', "
        "'array<struct<id: string, name: string, arguments: variant, depends_on: array<string>>>')"
    )
    text = F.expr("CASE WHEN schema_of_variant(c.arguments) = 'STRING' THEN variant_get(c.arguments, '$', 'string') ELSE to_json(c.arguments) END")
    calls = parsed.select("conv_id", "turn", F.posexplode(many).alias("at", "c")).select(
        "conv_id", F.col("c.id").alias("call_id"), F.struct("turn", "at").alias("position"),
        F.col("c.name").alias("name"), text.alias("arguments"),
        F.coalesce("c.depends_on", F.array().cast("array<string>")).alias("depends_on"),
    )
    results = parsed.select(
        "conv_id", F.expr("try_variant_get(v, '$.tool_call_id', 'string')").alias("call_id"),
        F.expr("try_variant_get(v, '$.content', 'string')").alias("content"),
    )
    return calls, results.dropna(subset=["call_id"])


def text_of_calls(calls: DataFrame, results: DataFrame, position: str = "position") -> DataFrame:
    """Turns (conv_id, turn, text) that `calls_in_text` reads as these calls and results.

    Each call has a turn of its own, whose number is its position; arguments are written as
    a text.  Results have no turn.
    """
    one = F.struct(F.col("call_id").alias("id"), "name", "arguments", "depends_on")
    told = F.to_json(F.struct(F.array(one).alias("tool_calls")))
    answer = F.to_json(F.struct(F.col("call_id").alias("tool_call_id"), "content"))
    return calls.select("conv_id", F.col(position).alias("turn"), told.alias("text")).unionByName(
        results.select("conv_id", F.lit(None).cast("bigint").alias("turn"), answer.alias("text"))
    )


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain conversations as calls and results.

    A user turn calls `reply` with its text and needs the user turn two before it, if
    there is one; a system turn calls `configure`; any other turn is the result of the
    call in the turn before it.  A turn without a number or a conversation is neither.
    """
    turns = conversations.select("conv_id", F.col("turn").cast("bigint"), F.lower("role").alias("role"), "text")
    turns = turns.dropna(subset=["conv_id", "turn"])
    call_id = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    asks = F.col("role").isin("user", "system")
    words = F.size(F.filter(F.split(F.trim("text"), r"\s+"), lambda w: w != "")).alias("words")
    reply = F.to_json(F.struct("turn", words, "text"))
    earlier = turns.filter("role = 'user'").select("conv_id", (F.col("turn") + 2).alias("turn"), F.lit(True).alias("_chained")).distinct()
    calls = turns.filter(asks).join(earlier, ["conv_id", "turn"], "left").select(
        "conv_id", call_id.alias("call_id"), F.col("turn").alias("position"),
        F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"),
        F.when(F.col("role") == "user", reply).otherwise(F.to_json(F.struct("text"))).alias("arguments"),
        F.when(
            F.col("_chained") & (F.col("role") == "user"),
            F.array(F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - 2).cast("string"))),
        ).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
    before = F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
    others = turns.filter(F.col("role").isNull() | ~asks)
    return calls, others.select("conv_id", before.alias("call_id"), F.col("text").alias("content"))
