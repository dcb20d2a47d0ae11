"""Deleting old trades, by age and by size.

Both rules delete a prefix of the time order, so a deletion is a cut: every row
before a time goes, and some of the rows at that very time.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.times import retention_cutoff
from tradelake.operators.cuts import Cut, time_cut
from tradelake.operators.ordered import repeat_rows, running_total
from tradelake.schemas import TRADE_COLUMNS
from tradelake.sources.table import MetadataTable, TradeTable

log = logging.getLogger(__name__)

# Fixed values.
MIB = 1024 * 1024
MAX_HEADROOM = 10 * 1024 * MIB
MIN_TARGET = 100 * MIB
MAX_BYTES_PER_ROW = 50


def retention_keep(trades: DataFrame, now_ms: int, hours: int) -> DataFrame:
    """Rows that survive the age rule; 0 hours keeps all, the cutoff itself stays."""
    if hours == 0:
        return trades
    return trades.filter(F.col("ts") >= retention_cutoff(now_ms, hours))


def retention_deleted(trades: DataFrame, now_ms: int, hours: int) -> DataFrame:
    """How many rows the age rule deletes."""
    old = F.lit(False) if hours == 0 else F.col("ts") < retention_cutoff(now_ms, hours)
    return trades.filter(old).agg(F.count(F.lit(1)).alias("deleted"))


def with_purge_plan(sizes: DataFrame) -> DataFrame:
    """Size rule for rows with ``size_bytes``, ``row_count`` and ``cap_bytes``.

    Above the target size, as many rows go as it takes to leave ``max_rows``.
    """
    steps = {
        "bytes_per_row": f"""CASE WHEN row_count = 0 THEN {MAX_BYTES_PER_ROW}L
            ELSE greatest(1L, least({MAX_BYTES_PER_ROW}L, size_bytes div row_count)) END""",
        "target_bytes": f"""least(cap_bytes, greatest({MIN_TARGET}L,
            cap_bytes - least(cap_bytes div 5, {MAX_HEADROOM}L)))""",
        "max_rows": "target_bytes div bytes_per_row",
        "to_delete": """CASE WHEN size_bytes <= target_bytes THEN 0L
            ELSE greatest(0L, row_count - max_rows) END""",
    }
    planned = sizes
    for name, text in steps.items():
        planned = planned.withColumn(name, F.expr(text))
    return planned


def _tie_order(trades: DataFrame) -> list[str]:
    rest = [name for name in trades.columns if name not in TRADE_COLUMNS]
    return ["exchange", "symbol", "price", "qty", "is_sell", *rest]


def _split_ties(trades: DataFrame, cut: Cut, oldest: bool) -> DataFrame:
    """The part of the rows at the cut that goes, or the part that stays.

    Equal rows are counted, not listed, so one huge group of copies is one row
    here, and the running count never sits in one task.
    """
    at_cut = trades.filter(F.col("ts") == cut.ts)
    copies = at_cut.groupBy(*trades.columns).agg(F.count(F.lit(1)).alias("copies"))
    placed = running_total(copies, _tie_order(trades), "copies")
    gone = F.greatest(F.lit(0), F.least("copies", F.lit(cut.ties) - F.col("before")))
    n = gone if oldest else F.col("copies") - gone
    counted = placed.withColumn("_n", n).select(*trades.columns, "_n")
    return repeat_rows(counted, F.col("_n")).select(*trades.columns)


def oldest_trades(trades: DataFrame, n: int) -> DataFrame:
    """The ``n`` globally oldest rows; ties go by the remaining columns."""
    cut = time_cut(trades, n)
    if cut is None:
        return trades if n > 0 else trades.limit(0)
    if cut.ties == cut.rows:
        return trades.filter(F.col("ts") <= cut.ts)
    older = trades.filter(F.col("ts") < cut.ts)
    return older.unionByName(_split_ties(trades, cut, oldest=True))


def purge_keep(trades: DataFrame, n: int) -> DataFrame:
    """All but the ``n`` globally oldest rows."""
    cut = time_cut(trades, n)
    if cut is None:
        return trades.limit(0) if n > 0 else trades
    newer = trades.filter(F.col("ts") > cut.ts)
    if cut.ties == cut.rows:
        return newer
    return newer.unionByName(_split_ties(trades, cut, oldest=False))


def check_startup_size(size_bytes: int, cap_bytes: int) -> bool:
    """Refuse a table more than twice its cap; True means above the cap."""
    if size_bytes > 2 * cap_bytes:
        raise ValueError(
            f"table is {size_bytes // MIB} MB, more than twice the cap "
            f"({cap_bytes // MIB} MB): raise the cap or shrink the table"
        )
    if size_bytes > cap_bytes:
        log.warning("table is above its cap; the next pass deletes the oldest trades")
        return True
    return False


def purge_by_age(table: TradeTable, now_ms: int, hours: int) -> int:
    """Delete what is older than ``hours``; 0 deletes nothing. Returns the rows."""
    if hours == 0:
        return 0
    table.settle()
    cutoff = retention_cutoff(now_ms, hours)
    boundary, deleted = table.period_of(cutoff), 0
    for start, rows in _period_rows(table):
        if start < boundary:
            table.drop_period(start)
            deleted += rows
        elif start == boundary:
            kept = table.period(start).filter(F.col("ts") >= cutoff)
            left = kept.count()
            if left < rows:
                table.replace_period(start, kept)
                deleted += rows - left
    return deleted


def _period_rows(table: TradeTable) -> list[tuple]:
    """Settled rows per period, oldest first, from the flush log."""
    counts = table.read_flushes().groupBy("dt").agg(F.sum("trades"))
    return sorted(tuple(row) for row in counts.collect())


def purge_by_size(table: TradeTable, cap_bytes: int, bytes_per_row: int | None = None) -> int:
    """Delete the oldest rows until the table is at its target size; returns the rows.

    Counts per period say which periods go whole; only the one in which the cut lies
    is read. ``bytes_per_row`` replaces what the stored files say.
    """
    table.settle()
    periods = _period_rows(table)
    rows = sum(n for _, n in periods)
    size = table.stored_bytes() if bytes_per_row is None else rows * bytes_per_row
    sizes = table.spark.createDataFrame(
        [(size, rows, cap_bytes)], "size_bytes bigint, row_count bigint, cap_bytes bigint"
    )
    left = deleted = with_purge_plan(sizes).first()["to_delete"]
    for start, n in periods:
        if left >= n:
            table.drop_period(start)
        elif left > 0:
            table.replace_period(start, purge_keep(table.period(start), left))
        left = max(left - n, 0)
    return deleted


@dataclass(frozen=True)
class CleanupResult:
    deleted_by_age: int | None
    deleted_by_size: int | None


def run_cleanup(
    table: TradeTable,
    metadata: MetadataTable,
    now_ms: int,
    hours: int,
    cap_bytes: int | None = None,
    bytes_per_row: int | None = None,
    at_startup: bool = False,
) -> CleanupResult:
    """One pass: age, then size, then ``last_cleanup`` if the age rule worked.

    The first pass after a start refuses a table more than twice its cap. A rule that
    fails has no count, and does not stop the other.
    """
    if at_startup and cap_bytes is not None:
        check_startup_size(table.stored_bytes(), cap_bytes)
    aged = sized = None
    try:
        aged = purge_by_age(table, now_ms, hours)
    except Exception:
        log.exception("age cleanup failed")
    if cap_bytes is not None:
        try:
            sized = purge_by_size(table, cap_bytes, bytes_per_row)
        except Exception:
            log.exception("size cleanup failed")
    if aged is not None:
        metadata.set("last_cleanup", str(now_ms), now_ms)
    return CleanupResult(aged, sized)
