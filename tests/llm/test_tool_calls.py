import json

import pytest

import __spark_entry__ as entry
from compare import assert_same, duck
from orderlens.llm import tool_calls
from orderlens.llm.queries import ORACLE_SQL

TOOLS = [
    ("add", "a", "integer", True), ("add", "b", "number", True), ("add", "note", "string", False),
    ("find", "where", "object", True), ("find", "tags", "array", False), ("find", "deep", "boolean", None),
    ("find", "gap", "null", False), ("find", "gap", "null", False),
]
CALLS = [
    ("c1", "x", 1, "add", '{"b": 2.5, "a": 1}', []),
    ("c1", "y", 2, "add", '{"a": 1, "b": 3, "note": "é \\"q\\" \\n"}', ["x"]),
    ("c1", "z", 3, "find", '{"where": {"b": [1, {"z": null, "a": 2}], "a": "t"}, "tags": [], "deep": true, "gap": null}', ["x", "y"]),
    ("c2", "x", 1, "add", '{"a": "1", "c": 2}', ["nobody"]),
    ("c2", "m", 2, "add", "{broken", None), ("c2", "l", 3, "add", "[1]", []), ("c2", "n", 4, "none", "{}", [None]),
    ("c2", "o", 5, "find", None, []),
    # needs a later call, twice over; and a loop that another call hangs on
    ("c3", "a", 1, "add", '{"a": 1, "b": 1}', ["b"]), ("c3", "b", 2, "add", '{"a": 1, "b": 1}', ["c"]),
    ("c3", "c", 3, "add", '{"a": 1, "b": 1}', []), ("c3", "d", 4, "add", '{"a": 1, "b": 1}', ["a"]),
    ("c4", "p", 1, "add", '{"a": 1, "b": 1}', ["q"]), ("c4", "q", 2, "add", '{"a": 1, "b": 1}', ["p"]),
    ("c4", "r", 3, "add", '{"a": 1, "b": 1}', ["q"]), ("c4", "s", 4, "add", '{"a": 1, "b": 1}', []),
    ("c4", "self", 5, "add", '{"a": 1, "b": 1}', ["self"]),
    ("c5", "k", 1, "add", '{"a": 1, "b": 1}', []), ("c5", "k", 1, "add", '{"a": 1, "b": 1}', []), ("c5", "k", 0, "add", '{"a": 9, "b": 1}', []),
    (None, "k", 1, "add", "{}", []), ("c6", None, 1, "add", "{}", []), ("c7", "t", None, None, '{"a": 1}', []),
]
RESULTS = [
    ("c1", "x", "3.5"), ("c1", "y", None), ("c2", "x", "b"), ("c2", "x", "a"), ("c2", "lost", "?"), (None, "x", "?"), ("c1", None, "?"),
]
CALL_TYPE = "conv_id string, call_id string, position bigint, name string, arguments string, depends_on array<string>"


@pytest.fixture(scope="module")
def tables(spark):
    return (
        spark.createDataFrame(CALLS, CALL_TYPE), spark.createDataFrame(RESULTS, "conv_id string, call_id string, content string"),
        spark.createDataFrame(TOOLS, "name string, parameter string, kind string, required boolean"),
    )


@pytest.fixture(scope="module")
def found(tables):
    return {(r.conv_id, r.call_id): r for r in tool_calls.formatted(*tables).collect()}


def test_one_row_per_call(found):
    assert set(found) == {(c[0], c[1]) for c in CALLS if c[0] and c[1]}
    assert found["c5", "k"].position == 0 and json.loads(found["c5", "k"].arguments)["a"] == 9


def test_results_are_linked(tables, found):
    assert {k: (r.answers, r.result) for k, r in found.items() if r.answers} == {
        ("c1", "x"): (1, "3.5"), ("c1", "y"): (1, None), ("c2", "x"): (2, "a"),
    }
    lost = tool_calls.unclaimed(tables[0], tables[1]).collect()
    assert sorted(str(r.call_id) for r in lost) == ["None", "lost", "x"]


def test_order_is_topological(found):
    place = {k: (r.level, r.position) for k, r in found.items()}
    for conv, call, _, _, _, needs in CALLS:
        for other in needs or []:
            if conv != "c4" and (conv, call) in place and (conv, other) in place:
                assert place[conv, other] < place[conv, call]
    assert [found["c3", c].level for c in "abcd"] == [2, 1, 0, 2]
    assert [found["c4", c].level for c in ("p", "q", "r", "self")] == [None] * 4 and found["c4", "s"].level == 0
    assert all(r.level == 0 for (c, _), r in found.items() if c not in ("c3", "c4"))


def test_levels_of_long_chains_and_branches(spark):
    """Against a plain walk: chains, branches, cycles, and chains into either, in one conversation."""
    needs = {f"n{i}": [f"n{i + 1}"] for i in range(70)} | {"n70": []}
    needs |= {"b1": ["n3", "n60"], "b2": ["b1", "n5"], "d1": ["b2"], "d2": ["d1"], "b3": ["d2", "e"], "e": []}
    needs |= {"c1": ["c2"], "c2": ["c3"], "c3": ["c1"], "f1": ["f2"], "f2": ["c1"], "b4": ["f1", "e"], "g": ["b4"]}
    position = {call: at for at, call in enumerate(needs)}

    def level(call, above=()):
        if call in above:
            return None
        found = [(level(n, (*above, call)), position[n] >= position[call]) for n in needs[call]]
        return None if any(at is None for at, _ in found) else max((at + later for at, later in found), default=0)

    rows = [("c", call, position[call], "t", "{}", list(on)) for call, on in needs.items()]
    got = tool_calls.ordered(tool_calls.distinct_calls(spark.createDataFrame(rows, CALL_TYPE))).collect()
    assert {r.call_id: r.level for r in got} == {call: level(call) for call in needs}
    assert {r.call_id for r in got if r.cyclic} == {"c1", "c2", "c3", "f1", "f2", "b4", "g"}


def test_arguments_are_checked(found):
    errors = {k: r.errors for k, r in found.items() if r.errors}
    assert errors == {
        ("c2", "x"): ["missing: b", "unknown: c", "wrong type: a"], ("c2", "m"): ["malformed"], ("c2", "l"): ["malformed"],
        ("c2", "n"): ["unknown tool"], ("c2", "o"): ["missing: where"], ("c7", "t"): ["unknown tool"],
    }
    bad = {k for k, r in found.items() if not r.valid}
    assert bad == {*errors, *(("c4", c) for c in ("p", "q", "r", "self"))}


def test_json_is_canonical(found):
    for conv, call, _, _, arguments, _ in CALLS:
        r = found.get((conv, call))
        if r and r.arguments and (conv, call) != ("c5", "k"):
            canonical = lambda v: json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            assert r.arguments == canonical(json.loads(arguments or "{}"))
            whole = {"arguments": json.loads(r.arguments), "call_id": call, "conv_id": conv, "errors": r.errors, "name": r.name, "result": r.result}
            assert r.record == canonical(whole)


def test_empty_tables(tables):
    calls, results, schemas = tables
    assert tool_calls.formatted(calls.limit(0), results, schemas).count() == 0
    rows = tool_calls.formatted(calls, results.limit(0), schemas.limit(0)).collect()
    assert all(r.answers == 0 and r.errors in (["unknown tool"], ["malformed"]) for r in rows)


def test_calls_are_read_from_turns(spark):
    call = {"tool_calls": [{"id": "x", "name": "add", "arguments": {"b": 1, "a": 2}}, {"id": "y", "name": "add", "arguments": {}, "depends_on": ["x"]}]}
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", json.dumps(call)), (1, 2, "tool", json.dumps({"tool_call_id": "x", "content": "3"})),
            (1, 3, "assistant", None), (None, None, None, None), (2, 0, "user", "[1, 2]")]
    calls, results = tool_calls.calls_in_text(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = {r.call_id: r for r in calls.collect()}
    assert set(got) == {"x", "y"} and got["x"].arguments == '{"a":2,"b":1}' and got["y"].depends_on == ["x"]
    assert got["x"].position < got["y"].position
    assert [tuple(r) for r in results.collect()] == [(1, "x", "3")]


def test_nothing_is_lost(spark, tables):
    """Every distinct call and result is in some row, with the number of its copies."""
    calls, results, schemas = tables
    rows = tool_calls.whole(calls, results, schemas).collect()
    rest = sorted(((r.conv_id, r.call_id, r.result, r.errors[0], r.copies) for r in rows if r.copies), key=str)
    assert rest == sorted([
        (None, "k", None, "call without an id", 1), ("c6", None, None, "call without an id", 1),
        ("c5", "k", None, "conflicting call", 2), ("c2", "x", "b", "further result", 1),
        ("c2", "lost", "?", "result without a call", 1), (None, "x", "?", "result without a call", 1),
        ("c1", None, "?", "result without a call", 1),
    ], key=str)
    assert not any(r.valid or r.level is not None for r in rows if r.copies)
    assert [r.unparsed for r in rows if r.errors == ["conflicting call"]] == ['{"a": 1, "b": 1}']
    assert sum(r.copies is None for r in rows) == len(tool_calls.formatted(calls, results, schemas).collect())
    # Arguments that can't be parsed stay, in the row and as a text in the record.
    (broken,) = [r for r in rows if r.call_id == "m"]
    assert broken.unparsed == "{broken" and json.loads(broken.record)["arguments"] == "{broken"


def test_leftover_of_odd_rows(spark, tables):
    calls, results, schemas = tables
    assert tool_calls.whole(calls.limit(0), results.limit(0), schemas).count() == 0
    assert {r.error for r in tool_calls.leftover(calls.limit(0), results).collect()} == {"result without a call"}
    long, tie = "x" * 2_000_000, None
    told = [("c1", "x", long), ("c1", "x", long), ("c1", "x", tie), ("c1", "x", ""), ("c1", "y", None), ("c1", "y", "z")]
    odd = spark.createDataFrame([(*r, 1, "clash") for r in told], "conv_id string, call_id string, content string, copies int, error string")
    got = sorted(((r.call_id, len(r.result or ""), r.result is None, r.copies) for r in tool_calls.leftover(calls.filter("conv_id = 'c1'"), odd).collect()))
    # The least text of x is the empty one, that of y is z; a null is a text that stays.
    assert got == [("x", 0, True, 1), ("x", len(long), False, 2), ("y", 0, True, 1)]


def test_written_turns_are_read_again(spark, tables):
    calls = tables[0].dropna(subset=["depends_on", "conv_id", "call_id"]).dropDuplicates()
    results = tables[1].dropna(subset=["call_id"])
    read, answers = tool_calls.calls_in_text(tool_calls.text_of_calls(calls, results))
    wanted = sorted(((r.conv_id, r.call_id, r.position, r.name, r.arguments, [n for n in r.depends_on]) for r in calls.collect()), key=str)
    found = sorted(((r.conv_id, r.call_id, r.position.turn, r.name, r.arguments, r.depends_on) for r in read.collect()), key=str)
    assert found == wanted
    assert sorted(map(tuple, answers.collect()), key=str) == sorted(map(tuple, results.collect()), key=str)


def test_many_calls_of_a_turn_keep_their_order(spark):
    many = [{"id": f"i{i}", "name": "add", "arguments": "{}"} for i in range(2_500)]
    rows = [(1, 0, json.dumps({"tool_calls": many})), (1, 1, json.dumps({"tool_calls": many[:1] + [{"id": "later", "name": "add"}]}))]
    calls, _ = tool_calls.calls_in_text(spark.createDataFrame(rows, "conv_id int, turn int, text string"))
    place = {(r.call_id, r.position.turn): r.position for r in calls.collect()}
    assert place["i2499", 0] < place["later", 1] and place["i999", 0] < place["i1000", 0]


def test_query_has_every_fault(spark, medium):
    rows = entry.queries()["op3_tool_calls"](spark, medium).collect()
    assert {r.errors for r in rows} == {
        "", "malformed", "unknown tool", "missing: text", "unknown: hint", "wrong type: words",
        "conflicting call", "further result", "result without a call",
    }
    assert {r.level for r in rows} >= {None, 0, 1, 2, 3} and any(r.level is None and r.copies is None for r in rows)
    assert any(not r.valid and not r.errors and r.level == 0 for r in rows)  # a need that does not exist


def test_plain_turns(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", " a  b "), (1, 2, "assistant", "c"), (1, 3, "user", ""), (1, 3, "user", ""),
            (1, 4, None, None), (2, 7, "assistant", "first"), (None, 1, "user", "x"), (3, None, "user", "x"), (4, 1, "USER", None)]
    calls, results = tool_calls.turns_as_calls(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = {r.call_id: r for r in calls.collect()}
    assert set(got) == {"1-0", "1-1", "1-3", "4-1"}
    assert json.loads(got["1-1"].arguments) == {"turn": 1, "words": 2, "text": " a  b "}
    assert got["1-3"].depends_on == ["1-1"] and got["1-1"].depends_on == []
    assert sorted((r.call_id, r.content or "") for r in results.collect()) == [("1-1", "c"), ("1-3", ""), ("2-6", "first")]


def test_query_equals_sql(spark, medium):
    with duck(medium) as connection:
        connection.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{medium}/conversations.parquet')")
        df = entry.queries()["op3_tool_calls"](spark, medium)
        assert assert_same(df, connection, ORACLE_SQL["op3_tool_calls"]) > 0


def test_no_python_on_the_way(spark, small):
    plan = entry.queries()["op3_tool_calls"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))
