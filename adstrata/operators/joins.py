"""Joins with dimensions, with a base group, and with a group-level value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.functions.numeric import share_pct


def literal_dimension(
    spark: SparkSession, rows: Sequence[tuple], schema: str
) -> DataFrame:
    """A dimension written in code. Spark knows its exact size and broadcasts it by itself."""
    return spark.createDataFrame(list(rows), schema)


def lookup_join(
    df: DataFrame,
    key: Column,
    dimension: DataFrame,
    dimension_key: str,
    outputs: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Left lookup in a dimension table with one row per key, with defaults for misses.

    No broadcast is forced: Spark broadcasts the dimension when its size is under the session
    threshold and shuffles otherwise.
    """
    defaults = dict(defaults or {})
    dim = dimension.select(
        F.col(dimension_key).alias("_dim_key"),
        *[F.col(source).alias(f"_dim_{out}") for out, source in outputs.items()],
    )
    joined = df.withColumn("_key", key).join(dim, F.col("_key") == F.col("_dim_key"), "left")
    values = [
        (
            F.coalesce(F.col(f"_dim_{out}"), F.lit(defaults[out]))
            if out in defaults
            else F.col(f"_dim_{out}")
        ).alias(out)
        for out in outputs
    ]
    return joined.select(*[F.col(c) for c in df.columns], *values)


def ratio_to_base(
    df: DataFrame,
    group: str,
    member: str,
    value: str,
    focus: str,
    base: str,
    carry: Sequence[str] = (),
    out: str = "pct_vs_base",
) -> DataFrame:
    """Value of one member per group as a percentage of the base member's value.

    Filtering the base side first turns the self-join into a join of two small slices.
    """
    base_side = df.where(F.col(member) == base).select(group, F.col(value).alias("_base"))
    return (
        df.where(F.col(member) == focus)
        .select(group, value, *carry)
        .join(base_side, group, "left")
        .select(group, value, *carry, share_pct(F.col(value), F.col("_base"), 1).alias(out))
    )
