"""Exact money: sums of whole numbers, rounded on output only.

Sums of binary floating-point prices depend on the order in which partitions
arrive; whole numbers do not.  A price keeps six decimals, so that prices below a
cent count in full: 1,000 times 0.125 is 125.

An amount that is to be summed is three BIGINT columns, its *parts*: millionths below
one unit, units below 10^9, and units above.  They are summed apart, over as many
levels as a report has, and become one DECIMAL after the last fold.  The parts of an
amount are small, so sums of them stay in range for any amounts that a table can hold
(9 * 10^12 rows of any price; 43,000 rows of the greatest price times the greatest
quantity); beyond that range Spark's ANSI mode ends the query, it never wraps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.model import MONEY, MONEY_DIGITS

#: Millionths in a unit, and the units from which on they count in the third part.
_MICROS, _MANY = 10**MONEY_DIGITS, 10**9
_PARTS = ("micros", "units", "billions")

#: Prices below this size are told apart by their DOUBLE value to six decimals, and times
#: any quantity they fit in a BIGINT.
_PLAIN_PRICE = 4e9

TOTAL = "decimal(38,6)"


def stored_price(price: Column) -> Column:
    """A price as it is stored; null if it is infinite, not a number or too large."""
    return price.try_cast(MONEY)


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """The amount of one order line, DECIMAL(31,6): no quantity and price overflow it."""
    return stored_price(unit_price) * quantity.cast("decimal(10,0)")


def part_names(name: str) -> list[str]:
    return [f"{name}_{part}" for part in _PARTS]


def with_line_parts(
    lines: DataFrame, name: str, quantity: str = "quantity", unit_price: str = "unit_price"
) -> DataFrame:
    """Add the parts of each line's amount; null if quantity or price is missing or the
    price can't be stored.

    A price whose DOUBLE value is that of a whole number of millionths is multiplied as
    that number, in generated code without objects; any other one goes through DECIMAL,
    which rounds it to six decimals first.
    """
    micros, units, billions = part_names(name)
    price = F.col(unit_price).cast("double")
    near = F.rint(price * float(_MICROS))
    plain = (F.abs(price) < _PLAIN_PRICE) & (near / float(_MICROS) == price)
    count, whole, small = f"_{name}_count", f"_{name}_whole", f"_{name}_small"
    staged = (
        lines.withColumns({
            count: F.col(quantity).cast("bigint"), whole: F.when(plain, near.cast("bigint")),
        })
        .withColumn(small, F.expr(f"{whole} % {_MICROS} * {count}"))
        .withColumn(whole, F.expr(f"{whole} div {_MICROS} * {count} + {small} div {_MICROS}"))
    )
    exact = line_amount(F.col(quantity), F.col(unit_price))
    rest = {micros: f"cast({{}} % 1 * {_MICROS} as bigint)", units: f"cast({{}} % {_MANY} as bigint)",
            billions: f"cast({{}} div {_MANY} as bigint)"}
    own = {micros: f"{small} % {_MICROS}", units: f"{whole} % {_MANY}", billions: f"{whole} div {_MANY}"}
    amount = f"_{name}_exact"
    staged = staged.withColumn(amount, F.when(F.col(whole).isNull(), exact))
    return staged.withColumns(
        {part: F.coalesce(F.expr(own[part]), F.expr(rest[part].format(amount))) for part in own}
    ).drop(count, whole, small, amount)


def sum_parts(name: str) -> list[Column]:
    """Aggregates that add up the parts of an amount, under the same names."""
    return [F.sum(part).alias(part) for part in part_names(name)]


def total(name: str) -> Column:
    """The amount that (sums of) parts stand for; null if there is none."""
    micros, units, billions = (F.col(part).cast("decimal(19,0)") for part in part_names(name))
    whole = billions * F.lit(_MANY).cast("decimal(10,0)") + units
    return (whole + micros * F.lit(10**-MONEY_DIGITS).cast(f"decimal({MONEY_DIGITS},{MONEY_DIGITS})")).cast(TOTAL)


def currency(amount: Column) -> Column:
    """An amount as shown: two decimals."""
    return F.round(amount, 2).cast("double")


def rounded(number: Column, digits: int) -> Column:
    return F.round(number.cast("double"), digits)
