"""Text normalisation that agrees with Python's `str.strip` and `str.title`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that Python also strips.
_BLANK = r"[\s\x1c-\x1f]"
# Anything but a cased letter in the Unicode sense; scripts without case count, too.
_NOT_CASED = r"([^\p{IsLowercase}\p{IsUppercase}\p{Lt}])"
# Put behind such characters for a moment. It reads unambiguously even if the text
# has the same pair, since each of its characters gets a mark of its own.
_MARK = "\x01 "


def strip_blanks(text: Column) -> Column:
    """Drop white space at both ends, including tabs and no-break spaces."""
    return F.regexp_replace(text, rf"(?U)^{_BLANK}+|{_BLANK}+$", "")


def title_case(text: Column) -> Column:
    """Capitalise after every character that is not a letter.

    `initcap` starts a word after blanks only and would leave "o'neil" as
    "O'neil"; so every other separator gets a blank first, which is then removed.
    Differs from `str.title` only for letters missing from one side's Unicode tables.
    """
    spaced = F.regexp_replace(text, _NOT_CASED, f"$1{_MARK}")
    return F.replace(F.initcap(spaced), F.lit(_MARK), F.lit(""))
