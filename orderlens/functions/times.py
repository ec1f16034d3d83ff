"""Parsing, month arithmetic and fractional day differences on local time."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tried in order after ISO 8601, on trimmed text. Slashed dates are read month first;
# one-letter parts take one digit or two.
DATE_FORMATS = (
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy h:mm:ss a",
    "M/d/yyyy h:mm a",
    "M/d/yyyy",
    "M-d-yyyy",
    "yyyy/M/d H:mm:ss.SSSSSS",
    "yyyy/M/d H:mm:ss",
    "yyyy/M/d H:mm",
    "yyyy/M/d",
    "yyyy-M-d h:mm:ss a",
    "yyyy-M-d h:mm a",
    "yyyyMMdd",
    "MMMM d, yyyy",
    "MMM d, yyyy",
    "d MMMM yyyy",
    "d MMM yyyy",
)

_MICROS_PER_DAY = 86_400_000_000.0


# What each pattern letter group matches; formats with other letters go unguarded.
_SHAPES = {
    "yyyy": r"\d{4}", "MMMM": r"\p{L}{3,}", "MMM": r"\p{L}{3}", "MM": r"\d{2}", "M": r"\d{1,2}",
    "dd": r"\d{2}", "d": r"\d{1,2}", "HH": r"\d{2}", "H": r"\d{1,2}", "h": r"\d{1,2}",
    "mm": r"\d{2}", "ss": r"\d{2}", "SSSSSS": r"\d{1,6}", "a": r"[AP]M",
}


def parse_timestamp(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Lenient parse: each value by the first format it fits, otherwise null."""

    def parse(value: Column) -> Column:
        # Eight bare digits are a calendar day, which ISO rules would read as a year.
        iso = F.when(~value.rlike(r"^\s*\d{5,}\s*$"), value).try_cast("timestamp_ntz")
        return F.coalesce(iso, *[_parse_as(value, f) for f in formats])

    # A lambda over one element names the text: should it be computed, a filter
    # pushed towards the scan would otherwise compute it anew for every format.
    return F.get(F.transform(F.array(F.trim(text)), parse), F.lit(0))


def _parse_as(text: Column, fmt: str) -> Column:
    """Parse by one format. A failed parse raises and catches inside Spark, at a
    hundred times the cost of the test for the right shape that comes first."""
    parsed = F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]+", fmt)
    if any(p.isalpha() and p not in _SHAPES for p in parts):
        return parsed
    shape = "".join(_SHAPES.get(p) or re.escape(p) for p in parts)
    return F.when(text.rlike(f"^{shape}$"), parsed)


def cut_to_second(moment: Column) -> Column:
    """Without the fraction; `date_trunc` would take a detour over the session zone."""
    fraction = F.date_part(F.lit("second"), moment) % 1
    return moment - F.make_dt_interval(secs=fraction)


def moment_literal(moment: datetime | str) -> Column:
    """A fixed local time, folded into the plan as a constant."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def month_number(moment: Column) -> Column:
    """Months since year 0: cheap to group by, and a difference is whole months."""
    return F.year(moment) * 12 + F.month(moment) - 1


def month_label(number: Column) -> Column:
    """`yyyy-MM` for a month number."""
    year = F.floor(number / 12).cast("int")
    return F.format_string("%04d-%02d", year, number - year * 12 + 1)


def days_between(later: Column, earlier: Column) -> Column:
    """Days as a fraction, so that 90 days and one second is more than 90."""
    seconds = (later - earlier).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("double") / F.lit(_MICROS_PER_DAY)
