"""Salary text to integers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adstrata import dictionaries as D
from adstrata.functions.text import WS, contains_any, digits_text, is_empty

# Building blocks of the accepted forms.
_GAP = f"[{WS}]*"
_NUM = "([0-9]+)"
_SPACED_NUM = f"([0-9][0-9{WS}]*)"
_DASH = f"{_GAP}[-–]{_GAP}"
_UNIT = "(?:mad|dhs?)"

EUR_RANGE = f"(?i){_NUM}{_DASH}{_NUM}{_GAP}eur"
EUR_SINGLE = f"(?i){_NUM}{_GAP}eur"
K_RANGE = f"(?i){_NUM}{_GAP}k{_DASH}{_NUM}{_GAP}k"
K_SINGLE = f"(?i){_NUM}{_GAP}k"
PLAIN_RANGE = f"{_SPACED_NUM}{_DASH}{_SPACED_NUM}"
PLAIN_SINGLE = f"(?i){_SPACED_NUM}{_GAP}{_UNIT}"


def _int(text: Column) -> Column:
    return text.try_cast("int")


def _joined_int(text: Column) -> Column:
    return _int(F.regexp_replace(text, f"[{WS}]+", ""))


def parse_salary(
    raw: Column,
    confidential: Sequence[str] = tuple(D.CONFIDENTIAL_WORDS),
    eur_rate: float = D.EUR_TO_MAD,
    eur_step: int = D.EUR_ROUNDING_STEP,
    text: Column | None = None,
    lowered: Column | None = None,
) -> Column:
    """STRUCT(min INT, max INT, currency STRING) from one salary text.

    Forms are tried in order and the first that occurs anywhere in the text wins. Converted
    amounts are rounded half-even to ``eur_step``. Amounts beyond INT become null. ``text`` and
    ``lowered`` take the prepared text from columns, so that it is prepared once per row.
    """
    text = digits_text(raw) if text is None else text
    lowered = F.lower(text) if lowered is None else lowered
    has_eur = F.contains(lowered, F.lit("eur"))
    has_k = F.contains(lowered, F.lit("k"))
    has_dash = F.contains(text, F.lit("-")) | F.contains(text, F.lit("–"))

    def group(pattern: str, i: int) -> Column:
        return F.regexp_extract(text, pattern, i)

    def from_eur(amount: Column) -> Column:
        scaled = amount.try_cast("double") * F.lit(float(eur_rate)) / F.lit(float(eur_step))
        return (F.rint(scaled) * F.lit(float(eur_step))).try_cast("int")

    def thousands(amount: Column) -> Column:
        return (amount.try_cast("bigint") * F.lit(1000)).try_cast("int")

    def result(low, high, currency: str) -> Column:
        return F.struct(low.alias("min"), high.alias("max"), F.lit(currency).alias("currency"))

    nothing = F.lit(None).cast("int")
    return (
        F.when(is_empty(raw), result(nothing, nothing, D.SALARY_MISSING))
        .when(
            contains_any(lowered, confidential) | (text == F.lit("")),
            result(nothing, nothing, D.SALARY_CONFIDENTIAL),
        )
        .when(
            has_eur & text.rlike(EUR_RANGE),
            result(
                from_eur(group(EUR_RANGE, 1)), from_eur(group(EUR_RANGE, 2)), D.CURRENCY_FROM_EUR
            ),
        )
        .when(
            has_eur & text.rlike(EUR_SINGLE),
            result(
                from_eur(group(EUR_SINGLE, 1)), from_eur(group(EUR_SINGLE, 1)), D.CURRENCY_FROM_EUR
            ),
        )
        .when(
            has_k & text.rlike(K_RANGE),
            result(thousands(group(K_RANGE, 1)), thousands(group(K_RANGE, 2)), D.CURRENCY_MAD),
        )
        .when(
            has_k & ~has_eur & text.rlike(K_SINGLE),
            result(thousands(group(K_SINGLE, 1)), thousands(group(K_SINGLE, 1)), D.CURRENCY_MAD),
        )
        .when(
            has_dash & text.rlike(PLAIN_RANGE),
            result(
                _joined_int(group(PLAIN_RANGE, 1)),
                _joined_int(group(PLAIN_RANGE, 2)),
                D.CURRENCY_MAD,
            ),
        )
        .when(
            text.rlike(PLAIN_SINGLE),
            result(
                _joined_int(group(PLAIN_SINGLE, 1)),
                _joined_int(group(PLAIN_SINGLE, 1)),
                D.CURRENCY_MAD,
            ),
        )
        .otherwise(result(nothing, nothing, D.SALARY_UNPARSEABLE))
    )


def is_inverted(low: Column, high: Column) -> Column:
    """Both bounds non-zero and in the wrong order."""
    return F.coalesce((low != 0) & (high != 0) & (low > high), F.lit(False))


def is_implausible(
    low: Column, bounds: tuple[int, int] = D.SALARY_PLAUSIBLE
) -> Column:
    """Non-zero lower bound outside the plausible interval."""
    return F.coalesce((low != 0) & ~low.between(*bounds), F.lit(False))


def midpoint(low: Column, high: Column) -> Column:
    """Half-even rounded middle of the two bounds, or the one that is known."""
    middle = F.rint((low.cast("double") + high.cast("double")) / F.lit(2.0)).cast("int")
    return F.coalesce(middle, low, high)
