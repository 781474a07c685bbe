"""What changed between two states of a table, with multiplicity.

One aggregate over both tables counts every distinct row on either side; the differences of the
counts are EXCEPT ALL in both directions, the smaller counts INTERSECT ALL. Nulls equal each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows of both tables with n_old and n_new. Columns go by name."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    both = old.withColumns({"__o": one, "__n": zero}).unionByName(new.withColumns({"__o": zero, "__n": one}))
    return both.groupBy(*old.columns).agg(F.sum("__o").alias("n_old"), F.sum("__n").alias("n_new"))


def _repeated(df: DataFrame, times) -> DataFrame:
    return df.withColumn("__times", times).where("__times > 0").select(
        *[c for c in df.columns if c not in ("n_old", "n_new")], F.explode(F.array_repeat(F.lit(0), F.col("__times").cast("int")))
    ).drop("col")


def except_all(old: DataFrame, new: DataFrame) -> DataFrame:
    return _repeated(compare(old, new), F.col("n_old") - F.col("n_new"))


def intersect_all(old: DataFrame, new: DataFrame) -> DataFrame:
    return _repeated(compare(old, new), F.least("n_old", "n_new"))


def change_report(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per key: rows that stay, go and come, and a kind: same, inserted, deleted or changed.

    A key is inserted or deleted if it has rows on one side only, changed if it has both but not the same.
    """
    per_key = compare(old, new).groupBy(*key).agg(
        F.sum(F.least("n_old", "n_new")).alias("kept"),
        F.sum(F.greatest(F.col("n_old") - F.col("n_new"), F.lit(0))).alias("gone"),
        F.sum(F.greatest(F.col("n_new") - F.col("n_old"), F.lit(0))).alias("added"),
    )
    kind = (
        F.when((F.col("gone") == 0) & (F.col("added") == 0), "same")
        .when((F.col("gone") == 0) & (F.col("kept") == 0), "inserted")
        .when((F.col("added") == 0) & (F.col("kept") == 0), "deleted")
        .otherwise("changed")
    )
    return per_key.withColumn("kind", kind)
