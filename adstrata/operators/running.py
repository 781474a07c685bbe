"""Windows over a whole table without a window of a whole table.

Running totals, row numbers, neighbours and tiles in a global order come in two levels: rows are
sorted by range, every range keeps its own window, and a table of one row per range carries totals
and border rows across. Moving windows of a fixed reach are dealt by buckets of that reach: what a
row can reach lies in its own bucket and the one before, so each row is copied once.

The order has to be a total one (end it with a key), or rows that tie get any of their places. Nulls
come first in the order; a null value adds nothing to a sum and is a neighbour like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adstrata.operators.instants import instant


def in_global_order(
    df: DataFrame,
    order: Sequence[str],
    path: str,
    sums: Mapping[str, str] | None = None,
    row_number: str | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    tiles: Mapping[str, int] | None = None,
) -> DataFrame:
    """The rows with running sums (new name: column), a row number, the previous and following row's values and
    NTILE numbers (new name: tiles).

    Ranges are sampled, so the sorted table is written to `path` once and both levels read that.
    """
    sums, previous, following, tiles = (dict(x or {}) for x in (sums, previous, following, tiles))
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__range", F.spark_partition_id())
    placed.write.parquet(path)
    rows = df.sparkSession.read.schema(placed.schema).parquet(path)

    place = F.struct(*order)
    ranges = rows.groupBy("__range").agg(
        F.count("*").alias("__n"),
        *[F.sum(c).alias(f"__s{i}") for i, c in enumerate(sums.values())],
        *[F.max_by(F.struct(c), place).alias(f"__p{i}") for i, c in enumerate(previous.values())],
        *[F.min_by(F.struct(c), place).alias(f"__f{i}") for i, c in enumerate(following.values())],
    )
    # One row per range, which is one per task of the sort: small, and safe to broadcast.
    by_range = Window.orderBy("__range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = ranges.select(
        F.col("__range"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n0"), F.sum("__n").over(whole).alias("__all"),
        *[F.sum(f"__s{i}").over(earlier).alias(f"__s{i}") for i in range(len(sums))],
        *[F.lag(f"__p{i}").over(by_range).alias(f"__p{i}") for i in range(len(previous))],
        *[F.lead(f"__f{i}").over(by_range).alias(f"__f{i}") for i in range(len(following))],
    )
    inside = Window.partitionBy("__range").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(F.broadcast(borders), "__range").withColumn("__row", F.row_number().over(inside) + F.col("__n0"))

    def total(i: int, column: str) -> Column:
        own, before = F.sum(column).over(upto), F.col(f"__s{i}")
        return F.when(own.isNull(), before).otherwise(own + F.coalesce(before, F.lit(0)))

    def neighbour(move, border: str, column: str) -> Column:
        return F.coalesce(move(F.struct(column)).over(inside), F.col(border))[column]

    def tile(n: int) -> Column:
        small, larger = F.floor(F.col("__all") / n), F.col("__all") % n
        head = larger * (small + 1)
        row = F.col("__row")
        return F.when(row <= head, F.ceil(row / (small + 1))).otherwise(larger + F.ceil((row - head) / small)).cast("long")

    return joined.select(
        *df.columns,
        *[total(i, c).alias(name) for i, (name, c) in enumerate(sums.items())],
        *([F.col("__row").cast("long").alias(row_number)] if row_number else []),
        *[neighbour(F.lag, f"__p{i}", c).alias(name) for i, (name, c) in enumerate(previous.items())],
        *[neighbour(F.lead, f"__f{i}", c).alias(name) for i, (name, c) in enumerate(following.items())],
        *[tile(n).alias(name) for name, n in tiles.items()],
    )


def moving(df: DataFrame, time: str, reach: int, aggregates: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """The rows with aggregates over all rows of their key from `reach` before their time up to it.

    That is RANGE BETWEEN reach PRECEDING AND CURRENT ROW, rows of the same time included. Aggregates are
    plain ones (new name: F.sum("x")). Rows without time have nulls.
    """
    names = list(df.columns)
    rows = df.select(F.struct(*names).alias("__row"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)],
                     instant(df, time).alias("__t"))
    bucket = F.floor(F.col("__t") / reach)
    copies = F.when(bucket.isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    dealt = rows.select("*", F.explode(copies).alias("__later")).withColumn(
        "__b", F.coalesce(bucket + F.col("__later"), F.pmod(F.xxhash64("__row"), F.lit(4096)))
    ).select("__row.*", "*")
    keys = [f"__k{i}" for i in range(len(by))]
    window = Window.partitionBy(*keys, "__b", F.col("__t").isNull()).orderBy("__t").rangeBetween(-reach, 0)
    known = [F.when(F.col("__t").isNotNull(), a.over(window)).alias(n) for n, a in aggregates.items()]
    return dealt.select(*names, "__later", *known).where("__later = 0").drop("__later")
