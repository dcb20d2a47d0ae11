"""Refused-access counters, summaries and sampled detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.operators.admission import ROWS_PER_CHUNK, admit

# Event kind and the counter it adds to.
COUNTERS = {
    "auth_failure": "auth_failures",
    "admission_blocked": "admission_blocked",
    "rate_limited": "rate_limited",
    "connection_rejected": "connection_rejected",
    "accept_timeout": "accept_timeouts",
}
SUMMARY_MS = 60_000
DETAIL_MS = 60_000
DETAIL_LIMIT = 5


def counters() -> list[Column]:
    return [F.count_if(F.col("kind") == kind).alias(name) for kind, name in COUNTERS.items()]


def access_counts(events: DataFrame) -> DataFrame:
    """Events of each kind per node since its start."""
    return events.groupBy("node_id").agg(*counters())


def interval_start(start_ms: int, interval_ms: int) -> Column:
    rest = f"pmod(at_ms - {start_ms}L, {interval_ms}L)"
    return F.expr(f"at_ms - {rest}").alias("interval_start_ms")


def access_summary(
    events: DataFrame, start_ms: int, interval_ms: int = SUMMARY_MS
) -> DataFrame:
    """Increase of each counter per interval; quiet intervals have no row.

    Intervals count from the node's start, and the last, partial one is included;
    events before the start lie in intervals before it.
    """
    known = events.filter(F.col("kind").isin(list(COUNTERS)))
    return known.groupBy("node_id", interval_start(start_ms, interval_ms)).agg(*counters())


def access_sample(
    events: DataFrame,
    start_ms: int,
    window_ms: int = DETAIL_MS,
    limit: int = DETAIL_LIMIT,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """The first ``limit`` events of each kind in every detail window of a node.

    A window begins at the first event at least ``window_ms`` after the last
    window's beginning, so windows follow the events and not a grid. That is the
    admission rule with capacity 1: an admitted event begins a window.
    """
    windows = admit(
        events,
        "node_id",
        capacity=1,
        window_ms=window_ms,
        first_open_ms=start_ms + window_ms,
        rows_per_chunk=rows_per_chunk,
    )
    # Spark keeps only `limit` rows of a group per task before it shuffles.
    order = Window.partitionBy("node_id", "window_start_ms", "kind").orderBy("at_ms", "seq")
    numbered = windows.withColumn("nth", F.row_number().over(order))
    return numbered.filter(F.col("nth") <= limit).select(
        *events.columns, "window_start_ms", F.col("nth").cast("bigint").alias("nth")
    )
