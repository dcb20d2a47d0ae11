"""Time coverage of pairs that follows a stream of trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake.operators.bounds import PAIR, configured_pairs
from tradelake.sources.files import Files


def start_pair_bounds(trades: DataFrame, checkpoint: str, until_caught_up: bool = False) -> StreamingQuery:
    """Keep the first and last trade time of every pair in the query's state store.

    A micro-batch is reduced to its pairs before it meets the state, so a pair with most
    of the trades is one row of it; the store changes by the pairs of the batch. Nothing
    is written besides: :func:`live_bounds` reads the store.
    """
    bounds = trades.groupBy(*PAIR).agg(F.min("ts").alias("earliest"), F.max("ts").alias("latest"))
    query = bounds.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    if until_caught_up:
        query = query.trigger(availableNow=True)
    return query.start()


def live_bounds(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The bounds as of the last committed micro-batch; empty before the first."""
    if not Files(spark, checkpoint).children(f"{checkpoint}/commits"):
        return spark.createDataFrame([], "exchange string, symbol string, earliest bigint, latest bigint")
    state = spark.read.format("statestore").load(checkpoint)
    ends = F.col("value").cast("struct<earliest: bigint, latest: bigint>").alias("ends")
    return state.select("key.exchange", "key.symbol", ends).select(*PAIR, "ends.*")


def live_pairs(spark: SparkSession, checkpoint: str, configured: DataFrame) -> DataFrame:
    """Every configured pair with its bounds so far. ``configured`` is read anew with
    each answer, so pairs that are added or left out show at once."""
    return configured_pairs(configured, live_bounds(spark, checkpoint))
