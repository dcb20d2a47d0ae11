"""Whitelist templates: venue -> market -> quotes, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPLATES = "map<string, map<string, array<string>>>"


def whitelist_from(spark: SparkSession, templates: dict) -> DataFrame:
    """A one-row DataFrame holding a configuration's templates."""
    return spark.createDataFrame([(templates,)], f"templates {TEMPLATES}")


def whitelist_rows(configs: DataFrame, templates: str = "templates") -> DataFrame:
    """One row per venue, market and quote; other columns are kept.

    An empty quote list gives no row. An empty quote is the wildcard.
    """
    kept = [name for name in configs.columns if name != templates]
    venues = configs.select(*kept, F.explode(templates).alias("venue", "_markets"))
    markets = venues.select(*kept, "venue", F.explode("_markets").alias("market", "_quotes"))
    return markets.select(*kept, "venue", "market", F.explode("_quotes").alias("quote"))
