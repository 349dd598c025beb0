"""Text helpers shared by the row contract and the file readers."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Every decimal digit outside ASCII and the ASCII digit it stands for.
_DIGITS = [
    c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"
]
_WIDE = "".join(_DIGITS)
_NARROW = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def strip(column: Column) -> Column:
    """Remove leading and trailing Unicode whitespace.

    Trimming by a set of characters is slow; values that start and end with a visible
    ASCII character do not need it.
    """
    return F.when(column.rlike(r"\A[!-~](?s:.*[!-~])?\z"), column).otherwise(
        F.btrim(column, F.lit(WHITESPACE))
    )


def is_blank(column: Column) -> Column:
    return column.isNull() | (strip(column) == "")


def full_match(column: Column, pattern: str) -> Column:
    """True when the whole value matches; ``$`` would accept a trailing newline."""
    return column.rlike(rf"\A(?:{pattern})\z")


def ascii_digits(column: Column) -> Column:
    """Replace any Unicode decimal digit by its ASCII form."""
    return F.when(
        column.rlike(r"[^\x00-\x7f]"), F.translate(column, _WIDE, _NARROW)
    ).otherwise(column)
