"""Normalising, routing and reading trades."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.symbols import stored_symbol
from tradelake.schemas import ANSWER_COLUMNS, TRADE_COLUMNS
from tradelake.sources.exchanges import exchange_filter


@dataclass(frozen=True)
class TradeQuery:
    venue: str
    symbol: str
    market: str
    from_ms: int | None = None
    to_ms: int | None = None
    limit: int | None = None


def normalize_trades(raw: DataFrame) -> DataFrame:
    """Storage form of raw trades (``ticker`` and optional ``display_symbol``)."""
    return raw.select(
        "exchange",
        stored_symbol(F.col("ticker"), F.col("display_symbol")).alias("symbol"),
        F.col("ts").cast("bigint").alias("ts"),
        F.col("price").cast("double").alias("price"),
        F.col("qty").cast("double").alias("qty"),
        F.col("is_sell").cast("boolean").alias("is_sell"),
    )


def route_trades(events: DataFrame) -> DataFrame:
    """Trades carried by an event stream; other kinds of event are not stored."""
    trades = events.filter(F.col("kind") == "trades").select(
        "exchange", F.explode("trades").alias("trade")
    )
    return normalize_trades(trades.select("exchange", "trade.*"))


def matching_trades(trades: DataFrame, query: TradeQuery) -> DataFrame:
    """Rows of one pair, within inclusive time bounds when given."""
    exchange = exchange_filter(query.venue, query.market)
    found = trades.filter(
        (F.col("symbol") == query.symbol.lower()) & (F.col("exchange") == exchange)
    )
    if query.from_ms is not None:
        found = found.filter(F.col("ts") >= query.from_ms)
    if query.to_ms is not None:
        found = found.filter(F.col("ts") <= query.to_ms)
    return found


def _in_order(found: DataFrame, query: TradeQuery) -> DataFrame:
    """Oldest first only when a lower bound is given; the rest breaks ties.

    Without a limit every row comes back, sorted over as many tasks as it takes. A
    given limit is kept as it is; its rows go through one task.
    """
    order = [F.col(name) for name in ANSWER_COLUMNS]
    if query.from_ms is None:
        order = [column.desc() for column in order]
    found = found.orderBy(*order)
    return found if query.limit is None else found.limit(query.limit)


def read_trades(trades: DataFrame, query: TradeQuery) -> DataFrame:
    """The read of a pair: its rows with their pair."""
    return _in_order(matching_trades(trades, query).select(*TRADE_COLUMNS), query)


def export_trades(trades: DataFrame, query: TradeQuery) -> DataFrame:
    """The same rows without their pair."""
    return _in_order(matching_trades(trades, query).select(*ANSWER_COLUMNS), query)


def batch_exchanges(trades: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Exchanges that have a row in each batch."""
    return trades.select(batch, "exchange").distinct()
