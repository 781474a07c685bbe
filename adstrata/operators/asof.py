"""As-of join: for every row of the left table the last row of the right one up to its time.

Both sides go into one table that is dealt by key and time bucket, so a key that makes a third of all
rows spreads over its buckets. A bucket needs one row from outside, the key's last right row before
it; those carries come from an aggregate of one row per key and bucket. Inside a bucket a
`last_value` over the sorted rows gives the match. No pairs are formed, every left row stays one row.

Nulls: left rows without key or time stay, unmatched; right rows without them match nothing. Of right
rows of one time the last by `ties` is taken. Empty tables give empty tables or unmatched rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adstrata.operators.instants import instant


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_by: Sequence[str],
    right_by: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Mapping[str, str],
    width: int,
    ties: Sequence[str] = (),
    forward: bool = False,
    allow_equal: bool = True,
    tolerance: int | None = None,
) -> DataFrame:
    """Left columns and, named as in `columns` (new name: right column), those of the matching right row.

    `width` is the bucket in the time's unit (microseconds for dates and timestamps). `forward` takes the
    first row from the left row's time on, `allow_equal=False` leaves out rows of that very time, and
    matches farther away than `tolerance` are nulls.
    """
    sign = -1 if forward else 1
    keys = [f"__k{i}" for i in range(len(left_by))]
    kept = F.struct(F.col("__t"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns.values())])
    rights = right.withColumn("__t", sign * instant(right, right_time)).select(
        *[F.col(c).alias(k) for k, c in zip(keys, right_by, strict=True)], "__t",
        F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(ties)]).alias("__tie"),
        kept.alias("__right"),
    ).dropna(subset=[*keys, "__t"])
    lefts = left.select(
        *[F.col(c).alias(k) for k, c in zip(keys, left_by, strict=True)],
        (sign * instant(left, left_time)).alias("__t"), F.struct(*left.columns).alias("__left"),
    )
    bucket = F.floor(F.col("__t") / width)
    lost = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in [*keys, "__t"]])
    # Rows that cannot match are dealt by their content; no right row is in such a bucket that could be theirs.
    rights = rights.withColumn("__b", bucket)
    lefts = lefts.withColumn("__b", F.when(lost, F.pmod(F.xxhash64("__left"), F.lit(4096))).otherwise(bucket))

    order = F.struct("__t", "__tie")
    ends = rights.groupBy(*keys, "__b").agg(
        F.max(order).alias("__end"), F.max_by("__right", order).alias("__right")
    )
    asked = lefts.where(~lost).select(*keys, "__b").distinct()
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    summary = ends.unionByName(asked, allowMissingColumns=True).groupBy(*keys, "__b").agg(
        F.max("__end").alias("__end"), F.max_by("__right", "__end").alias("__right")
    )
    carries = summary.select(
        *keys, "__b", F.last("__end", True).over(before).alias("__end"), F.last("__right", True).over(before).alias("__right")
    ).where("__end is not null")

    # At one time right rows stand before the left one if they may match it, else behind it.
    place = F.lit(1 if allow_equal else -1)
    columns_of = lambda df, t, tie, side: df.select(
        *keys, "__b", t.alias("__t"), side.alias("__side"), tie.alias("__tie"),
        *[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in ("__right", "__left")],
    )
    rows = (
        columns_of(rights, F.col("__t"), F.col("__tie"), F.lit(0))
        .unionByName(columns_of(carries, F.col("__end.__t"), F.col("__end.__tie"), F.lit(0)))
        .unionByName(columns_of(lefts, F.col("__t"), F.lit(None), place))
    )
    upto = Window.partitionBy(*keys, "__b").orderBy("__t", "__side", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    matched = rows.withColumn("__match", F.last("__right", True).over(upto)).where("__left is not null")
    if tolerance is not None:
        near = F.col("__t") - F.col("__match.__t") <= tolerance
        matched = matched.withColumn("__match", F.when(near, F.col("__match")))
    return matched.select("__left.*", *[F.col(f"__match.c{i}").alias(name) for i, name in enumerate(columns)])
