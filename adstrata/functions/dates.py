"""Dates written in several layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adstrata import dictionaries as D
from adstrata.functions.text import digits_text, strip

_YEAR, _MONTH, _DAY = "((?!0000)[0-9]{4})", "(1[0-2]|0?[1-9])", "(3[01]|[12][0-9]|0?[1-9]| [1-9])"


def _separators(layouts: Sequence[tuple[str, str]], order: str) -> str:
    return "".join("\\" + sep for o, sep in layouts if o == order)


def parse_date(
    raw: Column,
    layouts: Sequence[tuple[str, str]] = tuple(D.DATE_LAYOUTS),
    text: Column | None = None,
) -> Column:
    """DATE from text in any of the layouts, null when none fits the whole stripped text.

    The four-digit year sits at a fixed end, so the layouts exclude each other and their order
    does not matter. The text is rewritten to ISO form and cast, which (unlike a pattern-based
    timestamp parser tried once per layout) throws no exception for the rows that do not fit.
    """
    text = digits_text(raw) if text is None else text
    iso = F.lit(None).cast("string")
    for order, pattern, rewrite in (
        ("dmy", "^{d}([{s}]){m}\\2{y}$", "$4-$3-$1"),
        ("ymd", "^{y}([{s}]){m}\\2{d}$", "$1-$3-$4"),
    ):
        seps = _separators(layouts, order)
        if seps:
            full = pattern.format(d=_DAY, m=_MONTH, y=_YEAR, s=seps)
            iso = F.when(text.rlike(full), F.regexp_replace(text, full, rewrite)).otherwise(iso)
    return F.replace(iso, F.lit(" "), F.lit("")).try_cast("date")


def month_key(raw: Column, unknown: str = D.UNKNOWN_MONTH) -> Column:
    """``yyyy_MM`` of the first ten characters, or ``unknown``: the Bronze partition key.

    Only this key cuts the text to ten characters (so ISO timestamps get a month here).
    """
    day = parse_date(F.substring(strip(raw), 1, 10))
    return F.coalesce(F.date_format(day, "yyyy_MM"), F.lit(unknown))


def date_pair(published: Column, expires: Column) -> Column:
    """STRUCT(published, expires, valid) from two *parsed* dates.

    Unparseable publication: both null and invalid. Unparseable expiry: still valid.
    Publication after expiry: both kept, invalid. Equal dates are valid.
    """
    known = published.isNotNull()
    return F.struct(
        published.alias("published"),
        F.when(known, expires).alias("expires"),
        (known & F.coalesce(published <= expires, F.lit(True))).alias("valid"),
    )
