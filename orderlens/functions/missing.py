"""Missing-value handling for text files and floating-point columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that stand for "no value" in the raw files.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def na_to_null(text: Column) -> Column:
    """Null for the no-value tokens, otherwise the text unchanged."""
    return F.when(~text.isin(*NA_TOKENS), text)


def nan_to_null(number: Column) -> Column:
    """Null for NaN. Spark orders NaN above every number, so `NaN > 0` is true."""
    return F.when(~F.isnan(number), number)


def fill(value: Column, default: str) -> Column:
    """The value as text, or `default` where it is missing."""
    return F.coalesce(value.cast("string"), F.lit(default))
