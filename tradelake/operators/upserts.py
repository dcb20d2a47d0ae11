"""Last-write-wins tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.symbols import stored_symbol


def latest(log: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last row of each key, by one mergeable aggregate."""
    rest = [name for name in log.columns if name not in (*keys, seq)]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_row"))
    return last.select(*keys, *[F.col(f"_row.{name}").alias(name) for name in rest])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """``old`` with ``new`` written over it; ``seq`` orders repeats within ``new``."""
    before = old.withColumn("_new", F.lit(0)).withColumn(
        seq, F.lit(None).cast(new.schema[seq].dataType)
    )
    after = new.withColumn("_new", F.lit(1))
    both = before.unionByName(after)
    ranked = both.withColumn("_rank", F.struct("_new", seq)).drop("_new", seq)
    return latest(ranked, keys, "_rank")


def store_ticker_infos(stored: DataFrame, infos: DataFrame, seq: str) -> DataFrame:
    """Stored ticker sizes with those of resolved pairs written over them.

    ``infos`` have a ``ticker`` and an optional ``display_symbol``; they are stored
    under the spelling that trades are stored under.
    """
    symbol = stored_symbol(F.col("ticker"), F.col("display_symbol"))
    rows = infos.withColumn("symbol", symbol).select(*stored.columns, seq)
    return upsert(stored, rows, ["exchange", "symbol"], seq)


def metadata_value(metadata: DataFrame, key: str) -> DataFrame:
    """The value of one key; no row when absent."""
    return metadata.filter(F.col("key") == key).select("value")
