"""Exact interpolated percentiles that never gather a group in one task.

``percentile()`` keeps every distinct value of a group in one in-memory map, which a group with
a large share of the rows cannot afford. Here a first pass sketches each group (bounded size,
merged before the shuffle) to bracket the wanted order statistics, and a second pass counts what
lies below the bracket and ranks exactly the few values inside it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    accuracy: int = ACCURACY,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key with a linearly interpolated percentile per entry of ``probs``.

    Nulls of ``value`` are ignored; keys may be null. Groups without a value give no row. ``also``
    names further aggregates of ``df``, which ride on the sketch's pass and are joined to the finished
    groups; with it every group gives a row, its percentiles null if it has no value. The input is read
    twice either way.
    """
    keys = list(keys)
    data = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v")
    )
    margin = 2.0 / accuracy
    wanted = list(probs.values())
    cuts = [max(p - margin, 0.0) for p in wanted] + [min(p + margin, 1.0) for p in wanted]
    measured = F.col(value).cast("double")
    extras = list(also or {})
    # Without further aggregates the rows without value need not be looked at.
    sketch = (df if also else df.where(F.col(value).isNotNull())).groupBy(*keys).agg(
        F.count(measured).alias("_n"),
        F.percentile_approx(measured, [float(c) for c in cuts], accuracy).alias("_cuts"),
        *[column.alias(name) for name, column in (also or {}).items()],
    )
    brackets = sketch.where("_n > 0").select(
        *[F.col(k).alias(f"_b_{k}") for k in keys],
        "_n",
        # A small group is its own bracket.
        F.when(F.col("_n") > 4 * accuracy, F.col("_cuts")).alias("_cuts"),
    )
    same_key = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    )
    joined = data.join(brackets, same_key)

    # Per wanted percentile: values below the bracket collapse to null, values inside stay.
    def slot(i: int):
        low, high = F.col("_cuts")[i], F.col("_cuts")[len(wanted) + i]
        below = F.coalesce(F.col("_v") < low, F.lit(False))
        inside = F.coalesce(F.col("_v") <= high, F.lit(True))
        return F.when(
            below | inside,
            F.struct(F.lit(i).alias("i"), F.when(~below, F.col("_v")).alias("v")),
        )

    slots = joined.select(
        *keys, "_n", F.explode(F.array(*[slot(i) for i in range(len(wanted))])).alias("_s")
    ).where(F.col("_s").isNotNull())
    counted = slots.groupBy(*keys, "_n", F.col("_s.i").alias("_i"), F.col("_s.v").alias("_v")).agg(
        F.count(F.lit(1)).alias("_c")
    )
    running = (
        Window.partitionBy(*keys, "_i")
        .orderBy(F.asc_nulls_first("_v"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counted.withColumn("_upto", F.sum("_c").over(running)).withColumn(
        "_before", F.col("_upto") - F.col("_c")
    )

    def interpolated(i: int, p: float):
        position = (F.col("_n") - 1) * F.lit(float(p))
        lower = F.floor(position)

        def at(rank):
            hit = (F.col("_i") == i) & (F.col("_before") <= rank) & (rank < F.col("_upto"))
            return F.max(F.when(hit, F.col("_v")))

        low, high = at(lower), at(F.ceil(position))
        fraction = F.max(position - lower)
        # Equal neighbours are returned as they are: infinity minus infinity is no number.
        return F.when(low == high, low).otherwise(low + (high - low) * fraction)

    result = ranked.groupBy(*keys).agg(
        *[interpolated(i, p).alias(name) for i, (name, p) in enumerate(probs.items())],
    )
    # The sketch's error bound puts both ranks inside the bracket; fail loudly if ever not.
    checked = [
        F.coalesce(
            F.col(name), F.raise_error(F.lit(f"percentile {name} outside its bracket"))
        ).alias(name)
        for name in probs
    ]
    found = result.select(*keys, *checked)
    if not also:
        return found
    # Naming all its columns keeps this the very aggregate used above, so its exchange is reused.
    groups = sketch.where("_n >= 0 or _cuts is not null").select(*[F.col(k).alias(f"_g_{k}") for k in keys], *extras)
    same_group = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    joined = groups.join(found, same_group, "left")
    return joined.select(*[F.col(f"_g_{k}").alias(k) for k in keys], *probs, *extras)
