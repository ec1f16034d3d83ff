import random
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.functions import money
from orderlens.functions.missing import na_to_null, nan_to_null
from orderlens.functions.money import currency, line_amount
from orderlens.functions.text import strip_blanks, title_case
from orderlens.functions.times import (
    cut_to_second,
    days_between,
    moment_literal,
    month_label,
    month_number,
    parse_timestamp,
)


def evaluate(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


TEXTS = [
    "  o'neil MCDONALD-SMITH  ", "ph.d. bob2b x", "\tanna ", " li wei　", "", "   ",
    "\x1cx\x1f", "éric ÉMILE", "straße", "ßeta", "中a 日B", "ǆabc", "a1b2", "o’neil", "ΣΊΣΥΦΟΣ", "x\ny",
    "mc_donald", "ﬁrst", "ΑΣ ΑΣ", "ᲐᲑ აბგ", "İSTANBUL", "ẞa", "ǅxǄ", "\x01 a\x01b \x01\x01 c \x01", " \x01",
]


def test_strip_agrees_with_python(spark):
    assert evaluate(spark, TEXTS, "string", strip_blanks) == [t.strip() for t in TEXTS]


def test_title_agrees_with_python(spark):
    assert evaluate(spark, TEXTS, "string", title_case) == [t.title() for t in TEXTS]
    assert evaluate(spark, [None], "string", title_case) == [None]


def test_title_on_every_cased_letter_of_latin_greek_cyrillic(spark):
    letters = [chr(c) for c in range(0x21, 0x530)] + [chr(c) for c in range(0x1E00, 0x2000)]
    odd = {"ƛ", "ɤ"}  # gained a capital lately
    words = [f"{a}B {a} b{a}C" for a in letters if a not in odd]
    assert evaluate(spark, words, "string", title_case) == [w.title() for w in words]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-02 03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02", datetime(2024, 1, 2)),
        ("01/02/2024", datetime(2024, 1, 2)),
        ("01/02/2024 10:20:30", datetime(2024, 1, 2, 10, 20, 30)),
        ("2024/01/02", datetime(2024, 1, 2)),
        ("20240105", datetime(2024, 1, 5)),
        ("Jan 5, 2024", datetime(2024, 1, 5)),
        ("5 Jan 2024", datetime(2024, 1, 5)),
        ("2024", datetime(2024, 1, 1)),
        ("2024-13-01", None),
        ("2024-02-30", None),
        ("not_a_date", None),
        ("", None),
        ("   ", None),
        (None, None),
    ],
)
def test_parse(spark, text, expected):
    assert evaluate(spark, [text], "string", parse_timestamp) == [expected]


def test_parse_with_other_formats(spark):
    values = ["5.1.2024", "2024-01-05 7 PM", "Jan 05, 2024", "01/02/24"]
    formats = ("d.M.yyyy", "yyyy-MM-dd h a")
    assert evaluate(spark, values, "string", lambda c: parse_timestamp(c, formats)) == [
        datetime(2024, 1, 5), datetime(2024, 1, 5, 19), None, None,
    ]


def test_parse_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert evaluate(spark, ["01/02/2024 10:20:30"], "string", parse_timestamp) == [
            datetime(2024, 1, 2, 10, 20, 30)
        ]
        assert evaluate(
            spark, ["2024-07-01 00:00:00"], "string",
            lambda c: days_between(moment_literal("2024-01-01"), c.cast("timestamp_ntz")),
        ) == [-182.0]
        # A time that New York skipped.
        skipped = [datetime(2024, 3, 10, 2, 30, 5, 250000)]
        assert evaluate(spark, skipped, "timestamp_ntz", cut_to_second) == [
            datetime(2024, 3, 10, 2, 30, 5)
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sub_seconds_are_cut(spark):
    moments = [datetime(2024, 1, 2, 3, 4, 5, 999999)]
    assert evaluate(spark, moments, "timestamp_ntz", cut_to_second) == [
        datetime(2024, 1, 2, 3, 4, 5)
    ]


def test_days_are_fractional(spark):
    earlier = [datetime(2024, 1, 1, 12), datetime(2024, 1, 2), datetime(2024, 1, 3, 0, 0, 1)]
    days = evaluate(
        spark, earlier, "timestamp_ntz", lambda c: days_between(moment_literal("2024-01-03"), c)
    )
    assert days == [1.5, 1.0, -1 / 86400]


def test_months(spark):
    moments = [datetime(1999, 12, 31, 23, 59, 59), datetime(2000, 1, 1), datetime(987, 3, 1)]
    labels = evaluate(
        spark, moments, "timestamp_ntz", lambda c: month_label(month_number(c))
    )
    assert labels == ["1999-12", "2000-01", "0987-03"]
    numbers = evaluate(spark, moments, "timestamp_ntz", month_number)
    assert numbers[1] - numbers[0] == 1


def test_nan_is_missing(spark):
    assert evaluate(spark, [float("nan"), 1.0, None], "double", nan_to_null) == [None, 1.0, None]


def test_no_value_tokens(spark):
    values = ["NA", "N/A", "null", "NaN", "", "none", "Nan", "x", None]
    assert evaluate(spark, values, "string", na_to_null) == [
        None, None, None, None, None, "none", "Nan", "x", None,
    ]


@pytest.mark.parametrize("kind", ["double", "decimal(16,6)"])
def test_money_is_exact(spark, kind):
    prices = ["0.1", "0.2", "0.29", "1.13", "9999999999.99", "-4.35", "0.125", "0.000001"]
    df = spark.createDataFrame([(p,) for p in prices], "p string").select(
        F.col("p").cast(kind).alias("p")
    )
    amounts = [r.a for r in df.select(line_amount(F.lit(1000), F.col("p")).alias("a")).collect()]
    assert amounts == [Decimal(p) * 1000 for p in prices]
    total = df.agg(currency(F.sum(line_amount(F.lit(1), F.col("p")))).alias("t")).first().t
    assert total == 9999999997.49


def test_no_price_or_quantity_ends_a_job(spark):
    prices = [float("inf"), float("-inf"), float("nan"), 1e300, 1e14, 99999999999999.0, None, 0.0000004]
    df = spark.createDataFrame([(p,) for p in prices], "p double")
    rows = df.select(line_amount(F.lit(2_000_000_000), F.col("p")).alias("a")).collect()
    assert [r.a for r in rows] == [None] * 5 + [Decimal("99999999999999") * 2_000_000_000, None, 0]
    huge = spark.range(1000).select(F.lit(99999999999999.0).alias("p"))
    total = huge.agg(F.sum(line_amount(F.lit(2_147_483_647), F.col("p"))).alias("t")).first().t
    assert total == Decimal("99999999999999") * 2_147_483_647 * 1000


def test_common_shapes_of_dates(spark):
    texts = {
        "1/2/2024": (2024, 1, 2), " 01/02/2024 ": (2024, 1, 2), "01/02/2024 3:04:05": (2024, 1, 2, 3, 4, 5),
        "01-02-2024": (2024, 1, 2), "January 5, 2024": (2024, 1, 5), "May 5, 2024": (2024, 5, 5),
        "2024-01-02 03:04 PM": (2024, 1, 2, 15, 4), "2024/01/02 03:04:05.5": (2024, 1, 2, 3, 4, 5, 500_000),
        "12/31/2024 11:59 PM": (2024, 12, 31, 23, 59), "5 January 2024": (2024, 1, 5),
        "13/13/2024": None, "32/01/2024": None, "Juneteenth 5, 2024": None, "5": None,
    }
    want = [datetime(*parts) if parts else None for parts in texts.values()]
    assert evaluate(spark, list(texts), "string", parse_timestamp) == want


def parts_total(spark, rows, kind):
    """Sum of amounts of [(quantity, price)] by their parts, in one group and in two levels."""
    df = spark.createDataFrame([(q, None if p is None else str(p)) for q, p in rows], "quantity int, p string")
    lines = df.select("quantity", F.col("p").cast(kind).alias("unit_price"), F.monotonically_increasing_id().alias("i"))
    parts = money.with_line_parts(lines, "amount")
    assert parts.columns == [*lines.columns, *money.part_names("amount")]
    folded = parts.groupBy(F.col("i") % 3).agg(*money.sum_parts("amount")).agg(*money.sum_parts("amount"))
    each = [r.t for r in parts.select(money.total("amount").alias("t"), "i").orderBy("i").collect()]
    want = [r.a for r in lines.select(line_amount(F.col("quantity"), F.col("unit_price")).alias("a"), "i").orderBy("i").collect()]
    assert each == want
    return folded.select(money.total("amount").alias("t")).first().t


PRICES = ["0.1", "0.29", "-4.35", "0.125", "0.000001", "0.0000004", "0.1234565", "112.62625", "3999999999.999999",
          "4000000000.000001", "99999999999999.5", "1e300", "nan", "inf", "-inf", "123456789.0000005", None, "0", "-0.0"]


@pytest.mark.parametrize("kind", ["double", "decimal(20,6)", "decimal(12,8)", "float", "bigint"])
def test_parts_stand_for_the_exact_amount(spark, kind):
    if kind == "double":
        prices = PRICES
    elif "decimal" in kind:
        prices = [None, "0.1", "-4.35", "0.1234565", "999.125", "0.000001"] + ["99999999999999.5"] * ("20" in kind)
    else:
        prices = [None, "0", "7", "-16777216", "4000000001"]
    rows = [(q, p) for q in (1, -3, 49, 2_147_483_647, -2_147_483_648, 0, None) for p in prices]
    parts_total(spark, rows, kind)


def test_parts_of_random_prices(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(1, 100), f"{rng.randrange(10**9) / 10**rng.randrange(9)!r}") for _ in range(4000)]
    exact = sum(q * Decimal(p).quantize(Decimal("0.000001"), ROUND_HALF_UP) for q, p in rows)
    assert parts_total(spark, rows, "double") == exact


def test_sums_of_the_greatest_amounts(spark):
    rows = spark.range(40_000).select(F.lit(2_147_483_647).alias("quantity"), F.lit(99999999999999.0).alias("unit_price"))
    found = money.with_line_parts(rows, "a").agg(*money.sum_parts("a")).select(money.total("a")).first()[0]
    assert found == Decimal("99999999999999") * 2_147_483_647 * 40_000
    none = money.with_line_parts(rows.withColumn("unit_price", F.lit(None).cast("double")), "a")
    assert none.agg(*money.sum_parts("a")).select(money.total("a")).first()[0] is None


def test_sums_out_of_range_end_the_query(spark):
    rows = spark.range(100_000).select(F.lit(2_147_483_647).alias("quantity"), F.lit(99999999999999.0).alias("unit_price"))
    with pytest.raises(Exception, match="overflow"):
        money.with_line_parts(rows, "a").agg(*money.sum_parts("a")).collect()
