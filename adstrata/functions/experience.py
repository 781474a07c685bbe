"""Required-experience text to years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adstrata import dictionaries as D
from adstrata.functions.text import WS, any_of, contains_any, digits_text

_GAP = f"[{WS}]*"
YEARS_RANGE = f"([0-9]+){_GAP}[-àa]{_GAP}([0-9]+){_GAP}an"
YEARS_PLUS = f"([0-9]+){_GAP}\\+"
YEARS_FROM = f"([0-9]+){_GAP}an"


def parse_experience(
    raw: Column,
    beginner: Sequence[str] = tuple(D.BEGINNER_WORDS),
    strict: bool = False,
    text: Column | None = None,
) -> Column:
    """STRUCT(min INT, max INT) of years.

    By default the beginner words are plain substrings, so ``10 ans`` contains ``0 an`` and
    counts as entry level. ``strict=True`` requires that no digit stands before or after the
    word.
    """
    text = F.lower(digits_text(raw)) if text is None else text

    def years(pattern: str, i: int) -> Column:
        return F.regexp_extract(text, pattern, i).try_cast("int")

    def result(low: Column, high: Column) -> Column:
        return F.struct(low.cast("int").alias("min"), high.cast("int").alias("max"))

    nothing = F.lit(None)
    entry_level = (
        text.rlike(f"(?<![0-9])(?:{any_of(beginner)})(?![0-9])")
        if strict
        else contains_any(text, beginner)
    )
    return (
        F.when(entry_level, result(F.lit(0), F.lit(1)))
        .when(text.rlike(YEARS_RANGE), result(years(YEARS_RANGE, 1), years(YEARS_RANGE, 2)))
        .when(text.rlike(YEARS_PLUS), result(years(YEARS_PLUS, 1), nothing))
        .when(text.rlike(YEARS_FROM), result(years(YEARS_FROM, 1), nothing))
        .otherwise(result(nothing, nothing))
    )
