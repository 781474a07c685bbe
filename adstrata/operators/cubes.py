"""Marts at several levels at once: cube, rollup or chosen grouping sets with exact distinct counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def grouping_sets(
    df: DataFrame,
    dimensions: Sequence[str],
    key: str,
    distinct: str,
    sums: Mapping[str, str] | None = None,
    rows: str = "nb_rows",
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Row count, distinct non-null keys and sums for every grouping set (all subsets unless `sets` is given).

    Rows are first reduced to one per combination of dimensions and key, so the expansion into the sets
    works on those; distinct counts are then exact on every level, which no sum of lower levels would
    be. Of the rows of a key one per group of a set is marked and the marks are summed, so no level keeps
    the keys in a map and the expansion meets aggregates of few groups only. `grouping_id` has one bit per dimension, the first the highest, set where it is summed over; it
    tells that from a null value. An empty table gives no row.
    """
    sums = dict(sums or {})
    reduced = df.groupBy(*dimensions, F.col(key).alias("__key")).agg(
        F.count("*").alias("__n"), *[F.sum(c).alias(f"__s{i}") for i, c in enumerate(sums.values())]
    )
    if sets is None:
        sets = [c for n in range(len(dimensions) + 1) for c in combinations(dimensions, n)]
    known, marked = F.col("__key").isNotNull(), reduced.repartition("__key")
    ids = {sum(1 << i for i, d in enumerate(reversed(dimensions)) if d not in s): list(s) for s in sets}
    for i, chosen in ids.items():
        # Rows of a key are unique in all dimensions, so there every one is the first of its group.
        first = F.row_number().over(Window.partitionBy("__key", *chosen).orderBy(*dimensions)) == 1 if i else F.lit(True)
        marked = marked.withColumn(f"__d{i}", (known & first).cast("long"))
    columns = [F.col(c) for c in dimensions]
    grouped = marked.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().cast("long").alias("grouping_id"),
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias(rows),
        *[F.sum(f"__d{i}").alias(f"__d{i}") for i in ids],
        *[F.sum(f"__s{i}").alias(name) for i, name in enumerate(sums)],
    )
    of_set = F.coalesce(*[F.when(F.col("grouping_id") == i, F.col(f"__d{i}")) for i in ids], F.lit(0)).alias(distinct)
    return grouped.select(*dimensions, "grouping_id", rows, of_set, *sums)


def rollup_sets(dimensions: Sequence[str]) -> list[list[str]]:
    """The grouping sets of ROLLUP: all beginnings of the list, the empty one too."""
    return [list(dimensions[:i]) for i in range(len(dimensions), -1, -1)]
