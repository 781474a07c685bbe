"""Points in time as whole numbers, so buckets and distances are plain arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000_000
DAY = 86_400 * SECOND


def instant(df: DataFrame, name: str) -> Column:
    """Microseconds of a date or timestamp, a number as it is."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name).cast("long")
