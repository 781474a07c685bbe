"""Joins of intervals that overlap, without comparing every row with every other.

An interval belongs to the first level whose cells (each eight times as wide as the level below) are
as long as it, so it touches at most two cells there and at every level above. Two intervals meet at
the coarser of their levels: the join is an equality on key, level and cell, and a pair is emitted by
the cell in which the later of its starts lies, once. However long an interval is, it is copied a few times only;
open ones live on a last level of one cell. Only levels that the other side has are used.

Intervals hold both their ends, so a point is an interval of length zero. A null start or end is an
open one. Intervals that end before they start, and null keys, match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adstrata.operators.instants import instant

LEVELS = 8
FACTOR = 8
_LOW, _HIGH = -(2**62), 2**62


def _cells(level: Column, at: Column, widths: list[int]) -> Column:
    found = F.lit(0).cast("long")
    for i, width in enumerate(widths):
        found = F.when(level == i, F.floor(at / width)).otherwise(found)
    return found


def _with_levels(df: DataFrame, span: tuple[str, str], by: Sequence[str], widths: list[int]) -> DataFrame:
    start, end = (instant(df, c) for c in span)
    rows = df.select(
        F.struct(*df.columns).alias("row"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(by)],
        F.coalesce(start, F.lit(_LOW)).alias("start"), F.coalesce(end, F.lit(_HIGH)).alias("end"),
    ).where("start <= end")
    if by:
        rows = rows.dropna(subset=[f"k{i}" for i in range(len(by))])
    size = F.col("end") - F.col("start")
    level = F.lit(len(widths))
    for i in reversed(range(len(widths))):
        level = F.when(size <= widths[i], i).otherwise(level)
    return rows.withColumn("level", level)


def _placed(rows: DataFrame, others: list[int], widths: list[int]) -> DataFrame:
    """Rows once per cell in which they may meet rows of the other side's levels."""
    above = F.filter(F.array(*[F.lit(x) for x in others]), lambda x: x > F.col("level"))
    # Its own level serves all rows of the other side on levels not above it.
    own = F.when(F.col("level") >= min(others, default=len(widths) + 1), F.array("level")).otherwise(F.array().cast("array<int>"))
    met = rows.withColumn("at", F.explode(F.concat(own, above)))
    first, last = (_cells(F.col("at"), F.col(c), widths) for c in ("start", "end"))
    return met.withColumn("cell", F.explode(F.when(first == last, F.array(first)).otherwise(F.array(first, last))))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width: int,
    left_by: Sequence[str] = (),
    right_by: Sequence[str] = (),
) -> DataFrame:
    """Pairs of overlapping intervals as columns `l` and `r` (structs of the two rows).

    `width` is the smallest cell in the unit of the spans (microseconds for dates and timestamps); the
    length of most intervals is a good one.
    """
    widths = [width * FACTOR**i for i in range(LEVELS) if width * FACTOR**i < 2**62]
    sides = [
        _with_levels(df, span, by, widths) for df, span, by in ((left, left_span, left_by), (right, right_span, right_by))
    ]
    # At most LEVELS + 1 numbers each.
    present = [sorted(r["level"] for r in side.select("level").distinct().collect()) for side in sides]
    keys = [f"k{i}" for i in range(len(left_by))]
    a, b = (_placed(side, others, widths) for side, others in zip(sides, reversed(present), strict=True))
    a = a.select(*keys, "at", "cell", *[F.col(c).alias(f"l_{c}") for c in ("row", "start", "end", "level")])
    b = b.select(*keys, "at", "cell", *[F.col(c).alias(f"r_{c}") for c in ("row", "start", "end", "level")])
    pairs = a.join(b, [*keys, "at", "cell"])
    return pairs.where(
        (F.col("l_start") <= F.col("r_end")) & (F.col("r_start") <= F.col("l_end"))
        & (F.col("at") == F.greatest("l_level", "r_level"))
        & (F.col("cell") == _cells(F.col("at"), F.greatest("l_start", "r_start"), widths))
    ).select(F.col("l_row").alias("l"), F.col("r_row").alias("r"))


def overlap_counts(df: DataFrame, span: tuple[str, str], by: Sequence[str], weight: str, count: str) -> DataFrame:
    """Rows of `df` with the sum of `weight` of all rows of their key whose intervals overlap theirs, their own included.

    No pairs are formed: of the intervals that start up to a row's end, those that end before its start are taken
    off. Both are running totals over the distinct starts and ends of a key. Rows that match nothing are left out.
    """
    start, end = (instant(df, c) for c in span)
    rows = df.withColumns({"__start": F.coalesce(start, F.lit(_LOW)), "__end": F.coalesce(end, F.lit(_HIGH))})
    rows = rows.where("__start <= __end").dropna(subset=list(by))
    at = lambda c, s, e: F.struct(F.col(c).alias("__at"), s.cast("long").alias("__s"), e.cast("long").alias("__e"))
    ends = F.array(at("__start", F.col(weight), F.lit(0)), at("__end", F.lit(0), F.col(weight)))
    points = rows.select(*by, F.inline(ends))
    upto = Window.partitionBy(*by).orderBy("__at")
    totals = points.groupBy(*by, "__at").agg(F.sum("__s").alias("__s"), F.sum("__e").alias("__e")).select(
        *by, "__at", F.sum("__s").over(upto.rowsBetween(Window.unboundedPreceding, 0)).alias("__started"),
        F.coalesce(F.sum("__e").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__ended"),
    )
    started = totals.select(*by, F.col("__at").alias("__end"), "__started")
    ended = totals.select(*by, F.col("__at").alias("__start"), "__ended")
    found = rows.join(started, [*by, "__end"]).join(ended, [*by, "__start"])
    return found.select(*df.columns, (F.col("__started") - F.col("__ended")).alias(count))
