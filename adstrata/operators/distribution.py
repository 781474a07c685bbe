"""Value counts with shares, and counts of list members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.functions.numeric import share_pct


def value_counts(
    df: DataFrame, key: str, k: int | None = None, count: str = "nb", pct: str = "pct"
) -> DataFrame:
    """Rows per value with their share of all rows; the ``k`` most frequent when given.

    The total is a separate count (answered from file metadata on a plain scan), so no window
    runs over the groups.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    if k is not None:
        counted = counted.orderBy(F.desc(count), key).limit(k)
    return counted.withColumn(pct, share_pct(F.col(count), total))


def member_counts(
    df: DataFrame, members: Column, name: str, k: int | None = None, count: str = "nb"
) -> DataFrame:
    """Occurrences of each array member over all rows; the ``k`` most frequent when given."""
    counted = (
        df.select(F.explode(members).alias(name))
        .where(F.col(name) != "")
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias(count))
    )
    return counted if k is None else counted.orderBy(F.desc(count), name).limit(k)
