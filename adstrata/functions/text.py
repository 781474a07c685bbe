"""Whitespace, case and digit folding."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the Unicode standard (and Python's str.strip) treats as blank. SQL trim()
# alone removes only U+0020, and Java's \s is ASCII unless told otherwise.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex class body, for use inside [...]. Ranges keep the class quick to test.
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"
_ASCII_DIGITS = "01234567890123456789"


def strip(col: Column) -> Column:
    """Remove blanks of any kind from both ends."""
    return F.trim(col, F.lit(WHITESPACE))


def fold(col: Column) -> Column:
    """Lower-case and strip: the form every dictionary key is compared in."""
    return strip(F.lower(col))


def ascii_digits(col: Column) -> Column:
    """Rewrite Arabic-Indic digits so that numeric patterns and casts see 0-9."""
    # Text of as many bytes as characters has none, which is quicker to see than to translate.
    return F.when(F.octet_length(col) == F.length(col), col).otherwise(F.translate(col, _ARABIC_DIGITS, _ASCII_DIGITS))


def digits_text(raw: Column) -> Column:
    """Stripped text with ASCII digits: what the numeric and date parsers read."""
    return ascii_digits(strip(raw))


def is_empty(col: Column) -> Column:
    """Null or zero-length (blank text is *not* empty)."""
    return col.isNull() | (col == F.lit(""))


def in_small_methods(col: Column) -> Column:
    """The column as it is; a projection that has it is compiled into many small methods.

    Whole-stage code puts all expressions of a projection into one method, and the JVM never compiles
    a method of more than 8000 bytes but interprets it. A lambda keeps a projection out of that code.
    """
    return F.get(F.transform(F.array(col), lambda x: x), F.lit(0))


def any_of(literals: Iterable[str]) -> str:
    """Regex matching any of the literal strings."""
    return "|".join(quote(x) for x in literals)


def quote(literal: str) -> str:
    """Escape a literal for a Java regex, keeping letters, digits and spaces readable."""
    return re.sub(r"([^\w\s])", r"\\\1", literal)


def contains_any(col: Column, literals: Iterable[str]) -> Column:
    """True when any literal is a substring: one compiled pattern, small generated code."""
    return col.rlike(any_of(literals))
