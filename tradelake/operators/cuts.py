"""Finding the time that separates the first ``n`` rows from the rest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_OUT = 65_536
Between = Callable[[int, int], DataFrame]


@dataclass(frozen=True)
class Cut:
    """All rows on the near side of ``ts``, and ``ties`` of the ``rows`` at ``ts``."""

    ts: int
    ties: int
    rows: int


def time_cut(
    trades: DataFrame, n: int, newest: bool = False, between: Between | None = None
) -> Cut | None:
    """The cut that takes the ``n`` oldest (or newest) rows; None if there are fewer.

    Finds the time by narrowing a histogram: each pass counts rows in at most
    65,536 equal slices of the slice found before, down to one millisecond.
    ``between`` reads a time range where the stored layout can skip the rest.
    """
    between = between or (lambda low, high: trades.filter(F.col("ts").between(low, high)))
    if n <= 0:
        return None
    ends = trades.agg(F.min("ts"), F.max("ts")).first()
    low, high, left = ends[0], ends[1], n
    while low is not None:
        width = max(1, -(-(high - low + 1) // FAN_OUT))
        slice_no = F.expr(f"(ts - {low}L) div {width}L").alias("slice")
        counts = between(low, high).groupBy(slice_no).count().toPandas()
        counts = counts.sort_values("slice", ascending=not newest)
        reached = counts["count"].cumsum().to_numpy()
        place = int(reached.searchsorted(left))
        if place == len(reached):
            return None
        rows = int(counts["count"].iloc[place])
        left -= int(reached[place]) - rows
        start = low + int(counts["slice"].iloc[place]) * width
        low, high = start, min(high, start + width - 1)
        if width == 1:
            return Cut(low, left, rows)
    return None
