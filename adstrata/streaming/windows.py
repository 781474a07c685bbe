"""Event-time windows and sessions, the same expressions for tables and for streams.

On a stream a watermark bounds the state: a window or session is final, written once and forgotten when
the latest event seen is `delay` past its end; rows that come later still are dropped, and
`late_rows` of a finished run counts them. On a table every window is final.

Rows without time are in no window, and a null key is a group like any other. Partial counts are made
before the shuffle, so a key or window that makes a third of all rows is a few rows per task; a
session merges the sessions of its parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windows(events: DataFrame, time: str, length: str, by: Sequence[str], aggregates: Mapping[str, Column],
            delay: str | None = None) -> DataFrame:
    """Per key and window: window_start, window_end and the aggregates."""
    return _grouped(events, time, F.window(time, length), by, aggregates, delay)


def sessions(events: DataFrame, time: str, gap: str, by: Sequence[str], aggregates: Mapping[str, Column],
             delay: str | None = None) -> DataFrame:
    """Per key and run of events less than `gap` apart: window_start, window_end (last event plus gap) and the aggregates."""
    return _grouped(events, time, F.session_window(time, gap), by, aggregates, delay)


def _grouped(events: DataFrame, time: str, window: Column, by: Sequence[str], aggregates: Mapping[str, Column],
             delay: str | None) -> DataFrame:
    timed = events.withColumn(time, F.col(time).cast("timestamp")).where(F.col(time).isNotNull())
    if delay is not None:
        timed = timed.withWatermark(time, delay)
    grouped = timed.groupBy(*by, window.alias("w")).agg(*[a.alias(n) for n, a in aggregates.items()])
    return grouped.select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggregates)


def write_final(result: DataFrame, path: str, checkpoint: str) -> int:
    """Run what has arrived through a streamed `windows` or `sessions`, append the final ones; returns the late rows."""
    query = (
        result.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return sum(late_rows(p) for p in query.recentProgress)


def late_rows(progress) -> int:
    """Rows that a batch dropped as they came behind the watermark."""
    return sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
