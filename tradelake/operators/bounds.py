"""Time coverage of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.symbols import stored_symbol

PAIR = ["exchange", "symbol"]


def count_trades(trades: DataFrame) -> DataFrame:
    return trades.agg(F.count(F.lit(1)).alias("trades"))


def pair_bounds(trades: DataFrame) -> DataFrame:
    """First and last trade time of every stored pair."""
    bounds = trades.groupBy(*PAIR).agg(
        F.min("ts").alias("earliest"), F.max("ts").alias("latest")
    )
    return bounds.orderBy(*PAIR)


def merge_bounds(*parts: DataFrame) -> DataFrame:
    """Combine bounds kept per batch, so a read need not scan the trades."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.groupBy(*PAIR).agg(
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest")
    )


def configured_pairs(configured: DataFrame, bounds: DataFrame) -> DataFrame:
    """Every configured pair with its bounds, in configured order.

    A pair with trades shows its stored spelling, one without the configured
    ticker. Stored pairs that are not configured do not appear.
    """
    wanted = configured.select(
        "pos",
        "exchange",
        F.col("symbol").alias("_ticker"),
        stored_symbol(F.col("symbol"), F.col("display_symbol")).alias("_stored"),
    )
    stored = bounds.select("exchange", F.col("symbol").alias("_stored"), "earliest", "latest")
    stored = stored.withColumn("_hit", F.lit(True))
    joined = wanted.join(stored, ["exchange", "_stored"], "left")
    return joined.select(
        "pos",
        "exchange",
        F.when(F.col("_hit"), F.col("_stored")).otherwise(F.col("_ticker")).alias("symbol"),
        "earliest",
        "latest",
    ).orderBy("pos")


def tracked_counts(pairs: DataFrame) -> DataFrame:
    """Number of tracked pairs and of exchanges among them."""
    per_exchange = pairs.groupBy("exchange").agg(F.count(F.lit(1)).alias("n"))
    return per_exchange.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tracked_count"),
        F.count(F.lit(1)).alias("exchange_count"),
    )
