"""Top-k and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k rows with the largest ``by``, nulls last, ties broken by the given columns."""
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(k)


def top_k_ranked(df: DataFrame, by: str, k: int, ties: Sequence[str], rank: str) -> DataFrame:
    """Global RANK() of the top k.

    Every row that outranks one of the top k is itself among them, so ranking after the limit
    gives the global rank without sorting the whole table in one task.
    """
    order = Window.orderBy(F.desc_nulls_last(by))
    return top_k(df, by, k, ties).withColumn(rank, F.rank().over(order))


def rank_within(df: DataFrame, group: str, by: str, rank: str, dense: bool = False) -> DataFrame:
    """RANK() or DENSE_RANK() by descending value within each group of an aggregated table."""
    order = Window.partitionBy(group).orderBy(F.desc_nulls_last(by))
    return df.withColumn(rank, (F.dense_rank() if dense else F.rank()).over(order))
