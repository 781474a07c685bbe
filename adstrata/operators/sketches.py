"""Sketches as columns of a mart: distinct counts and quantiles that merge upward without the rows.

A mart holds one HyperLogLog and one quantile sketch per group, both of bounded size. A coarser level
merges them, which equals sketching its rows directly for distinct counts and keeps the error bound
for quantiles. Null values are in neither sketch; a group without values has null estimates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of the distinct sketch as a power of two, and size of the quantile sketch.
LOG_REGISTERS = 12
QUANTILE_K = 400


def distinct_error(log_registers: int = LOG_REGISTERS) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / math.sqrt(2**log_registers)


def rank_error(k: int = QUANTILE_K) -> float:
    """Bound (99 % confidence) of a quantile's error in rank."""
    return 2.296 / k**0.9021


def sketch(df: DataFrame, by: Sequence[str], key: str, value: str) -> DataFrame:
    """Per group: `distinct_sketch` of the key and `quantile_sketch` of the value."""
    return df.groupBy(*by).agg(
        F.hll_sketch_agg(F.col(key), F.lit(LOG_REGISTERS)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_K)).alias("quantile_sketch"),
    )


def merge(mart: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same mart at a coarser level."""
    return mart.groupBy(*by).agg(
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def distinct_estimate(column: str = "distinct_sketch") -> Column:
    return F.hll_sketch_estimate(column)


def quantile_estimate(share: float, column: str = "quantile_sketch") -> Column:
    return F.when(F.kll_sketch_get_n_double(column) > 0, F.kll_sketch_get_quantile_double(column, F.lit(share)))
