"""Rounding, shares and correlation with explicit edge cases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back, all in double arithmetic.

    Spark's ``round(double, n)`` rounds the shortest decimal text instead, which differs on
    values such as 1.005. Negative values that round to zero stay negative zero, as in SQL
    engines that round in binary.
    """
    scaled = value.cast("double") if digits == 0 else value.cast("double") * F.lit(10.0**digits)
    rounded = F.abs(F.round(scaled, 0)) * F.signum(scaled)
    return rounded if digits == 0 else rounded / F.lit(10.0**digits)


def share_pct(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``100 * part / whole`` as double; null when ``whole`` is zero or null."""
    pct = F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
    return pct if digits is None else round_to(pct, digits)


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over the pairs where both are known; null for zero variance."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.try_divide(F.covar_pop(xs, ys), F.nullif(spread, F.lit(0.0)))


def level(value: Column, steps: Sequence[tuple[str, float]], rest: str) -> Column:
    """Label of the first step the value lies strictly above; null and the rest get ``rest``."""
    label = F.lit(rest)
    for name, above in reversed(list(steps)):
        label = F.when(value > F.lit(above), F.lit(name)).otherwise(label)
    return label


def band(
    value: Column, bands: Sequence[tuple[str, int, int | None]], rest: str
) -> tuple[Column, Column]:
    """(label, ordinal) of the inclusive band holding ``value``; the ordinal gives the order."""
    label, ordinal = F.lit(rest), F.lit(len(bands))
    for i, (name, low, high) in reversed(list(enumerate(bands))):
        inside = value >= low if high is None else value.between(low, high)
        label = F.when(inside, F.lit(name)).otherwise(label)
        ordinal = F.when(inside, F.lit(i)).otherwise(ordinal)
    return label, ordinal
