"""Ten-second event-time summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import times

SIZE = "10 seconds"
DELAY = "2 seconds"
# a stream that waits 10 s for its pattern and 2 s for late rows is part of the union
UNION_DELAY = "14 seconds"


def with_delay(rows: DataFrame, time: str, delay: str = DELAY) -> DataFrame:
    """Watermark; without effect on bounded inputs."""
    return rows.withWatermark(time, delay) if rows.isStreaming else rows


def tumbling(
    rows: DataFrame, time: str, measures: dict[str, Column], keys: list[str] | None = None, size: str = SIZE
) -> DataFrame:
    """Aggregate per time window, and per key if any.

    There is no single-task window over everything: the window itself is a
    grouping key, and Spark combines rows before the shuffle.
    """
    span = F.window(time, size).alias("_window")
    totals = rows.groupBy(span, *(keys or [])).agg(*[value.alias(name) for name, value in measures.items()])
    return totals.select(
        times.time_text("_window.start").alias("stt"),
        times.time_text("_window.end").alias("edt"),
        *(keys or []),
        *measures,
    )


def total(name: str) -> Column:
    return F.sum(name).cast("bigint")


def stamped(summary: DataFrame, columns: list[str], clock: Column | None = None) -> DataFrame:
    """Add the wall clock (or ``clock``) as ``ts`` and put columns in the store's order."""
    return summary.withColumn("ts", times.now_millis() if clock is None else clock).select(*columns)
