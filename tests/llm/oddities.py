import pytest

LONG = "one long text of many words, again and again. " * 6000
PASSAGE = (
    "The passage that many share begins here. It has several sentences of some length. "
    "Each of them is an ordinary one! Nobody wrote it twice, and yet it stands in many texts. "
    "This is how it ends, after more than fifty words, as passages that are worth finding do; "
    "no shorter one would do for a test of this kind."
)

#: Nulls, blanks, one word, repeated rows, equal keys, a very long text, odd characters.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, LONG), (5, LONG),
    (6, "Ünïcode ΑΣ <|endoftext|> don't 12   \U0001f600\x1cx"), (7, "word"), (8, "WORD"),
    (9, f"Before it stands this. {PASSAGE}\nAnd this after."), (10, f"other words {PASSAGE}"),
    (10, "another text with the key of the one before"), (11, "#*$ a\n#*$ a\n\n#*$ a"),
    (None, "a text without a key"), (None, None), (12, "x" * 3000),
    (13, "a b c d " * 20), (14, "a b c d " * 20 + "e"),
]
CLASHES = ("bits", "spans", "identity", "place", "tie", "starts", "key", "code", "counts",
           "contamination", "component", "_row", "node", "u", "v")


@pytest.fixture(scope="session")
def odd(spark):
    """ODD with further columns whose names the operators use themselves."""
    schema = "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASHES)
    rows = [(k, t, *(f"{c} {i}" for c in CLASHES)) for i, (k, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark, odd):
    return spark.createDataFrame([], odd.schema)
