"""The exchange dimension: a fixed table of 14 rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Exchange, venue, market, joiner between base and quote, suffix.
# A joiner of None means that the ticker is the base alone.
EXCHANGES = [
    ("Binance Spot", "binance", "spot", "", ""),
    ("Binance Linear", "binance", "linear", "", ""),
    ("Binance Inverse", "binance", "inverse", "", "_PERP"),
    ("Bybit Spot", "bybit", "spot", "", ""),
    ("Bybit Linear", "bybit", "linear", "", ""),
    ("Bybit Inverse", "bybit", "inverse", "", ""),
    ("Mexc Spot", "mexc", "spot", "", ""),
    ("Mexc Linear", "mexc", "linear", "_", ""),
    ("Mexc Inverse", "mexc", "inverse", "_", ""),
    ("Hyperliquid Spot", "hyperliquid", "spot", None, ""),
    ("Hyperliquid Linear", "hyperliquid", "linear", None, ""),
    ("Okex Spot", "okex", "spot", "-", ""),
    ("Okex Linear", "okex", "linear", "-", "-SWAP"),
    ("Okex Inverse", "okex", "inverse", "-", "-SWAP"),
]
EXCHANGE_COLUMNS = ["exchange", "venue", "market", "joiner", "suffix"]
VENUES = sorted({row[1] for row in EXCHANGES})
MARKETS = ["spot", "linear", "inverse"]
_BY_VENUE_MARKET = {(row[1], row[2]): row[0] for row in EXCHANGES}


def exchanges(spark: SparkSession) -> DataFrame:
    def literal(value: str | None) -> str:
        return "CAST(NULL AS STRING)" if value is None else f"'{value}'"

    rows = ", ".join(f"({', '.join(map(literal, row))})" for row in EXCHANGES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(EXCHANGE_COLUMNS)})")


def exchange_filter(venue: str, market: str) -> str:
    """Exchange name of one request.

    An unknown venue or market is an error. A known but unsupported pair gives
    ``venue/market``, a name no stored row carries.
    """
    wanted = venue.lower(), market.lower()
    if wanted[0] not in VENUES:
        raise ValueError(f"unknown venue: '{venue}'")
    if wanted[1] not in MARKETS:
        raise ValueError(
            f"unknown market kind: '{market}' (expected spot, linear, or inverse)"
        )
    return _BY_VENUE_MARKET.get(wanted, f"{venue}/{market}")


def with_exchange_filter(requests: DataFrame) -> DataFrame:
    """Batch form of :func:`exchange_filter` for rows with ``venue`` and ``market``.

    Adds ``exchange`` (null on error) and ``error`` (null on success).
    """
    names = exchanges(requests.sparkSession).select(
        F.col("venue").alias("_venue"), F.col("market").alias("_market"), "exchange"
    )
    venue, market = F.lower("venue"), F.lower("market")
    error = F.when(
        ~venue.isin(VENUES), F.concat(F.lit("unknown venue: '"), "venue", F.lit("'"))
    ).when(
        ~market.isin(MARKETS),
        F.concat(
            F.lit("unknown market kind: '"),
            "market",
            F.lit("' (expected spot, linear, or inverse)"),
        ),
    )
    fallback = F.concat("venue", F.lit("/"), "market")
    matched = requests.join(
        F.broadcast(names), (venue == F.col("_venue")) & (market == F.col("_market")), "left"
    )
    return matched.select(
        *requests.columns,
        F.when(error.isNull(), F.coalesce("exchange", fallback)).alias("exchange"),
        error.alias("error"),
    )
