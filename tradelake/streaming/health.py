"""Feed health, write health and saturation kept up to date from streams of events.

States are one row per feed, node or latch. A micro-batch is folded into partials, hot
keys by stretches of their time, and merged with the state before it. Batches count as
consecutive: an event that comes late follows what came before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake.operators import flushes, pipeline
from tradelake.operators.feeds import PARTIAL, feed_partials, health_of, merge_partials
from tradelake.streaming.state import BatchState, each_batch


def _schema(keys: list[str], events: DataFrame, rest: str) -> str:
    kinds = [f"{key} {events.schema[key].dataType.simpleString()}" for key in keys]
    return ", ".join([*kinds, rest])


def _in_turn(before: DataFrame, now: DataFrame) -> DataFrame:
    """The state before a batch and what the batch adds, as consecutive stretches."""
    first, second = (F.lit(n).cast("bigint") for n in (-1, 0))
    return before.withColumn("stretch", first).unionByName(now.withColumn("stretch", second))


def start_feed_health(
    events: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None
) -> StreamingQuery:
    """Keep one partial per feed, as of the last micro-batch.

    A feed that sends most of the events does not end up in one task.
    """
    keys = keys or ["exchange"]
    schema = _schema(keys, events, PARTIAL)

    def work(batch: DataFrame, query: str, batch_id: int) -> None:
        def step(before: DataFrame) -> DataFrame:
            now = merge_partials(feed_partials(batch, keys), keys)
            return merge_partials(_in_turn(before, now), keys)

        BatchState(batch.sparkSession, path).fold(query, batch_id, schema, step)

    return each_batch(events, checkpoint, work)


def read_feed_health(
    spark: SparkSession, path: str, events: DataFrame, keys: list[str] | None = None
) -> DataFrame:
    """Health as of the last stored micro-batch of ``events``."""
    keys = keys or ["exchange"]
    return health_of(BatchState(spark, path).read(_schema(keys, events, PARTIAL)), keys)


# Write health


def start_pipeline_health(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep one partial per node of its flush events, as of the last micro-batch."""
    keys = ["node_id"]
    schema = _schema(keys, events, flushes.PARTIAL)

    def work(batch: DataFrame, query: str, batch_id: int) -> None:
        def step(before: DataFrame) -> DataFrame:
            now = flushes.merge_partials(flushes.flush_partials(batch, keys), keys)
            return flushes.merge_partials(_in_turn(before, now), keys)

        BatchState(batch.sparkSession, path).fold(query, batch_id, schema, step)

    return each_batch(events, checkpoint, work)


def read_pipeline_health(spark: SparkSession, path: str, events: DataFrame) -> DataFrame:
    """Write health as of the last stored micro-batch of ``events``."""
    schema = _schema(["node_id"], events, flushes.PARTIAL)
    return flushes.health_of(BatchState(spark, path).read(schema), ["node_id"])


# Saturation


LATCHES = "stage string, latch string, set boolean"


def start_saturation(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the last signal of every latch, as of the last micro-batch."""
    schema = _schema(["node_id"], events, LATCHES)

    def work(batch: DataFrame, query: str, batch_id: int) -> None:
        def step(before: DataFrame) -> DataFrame:
            both = _in_turn(before, pipeline.last_signals(batch))
            return both.groupBy("node_id", "stage", "latch").agg(F.max_by("set", "stretch").alias("set"))

        BatchState(batch.sparkSession, path).fold(query, batch_id, schema, step)

    return each_batch(events, checkpoint, work)


def read_saturation(spark: SparkSession, path: str, events: DataFrame) -> DataFrame:
    """Saturation as of the last stored micro-batch of ``events``."""
    state = BatchState(spark, path).read(_schema(["node_id"], events, LATCHES))
    return pipeline.saturation_of(state)


# Status


def read_overall_status(
    spark: SparkSession,
    paths: dict[str, str],
    events: dict[str, DataFrame],
    database_ok: Column | bool = True,
) -> DataFrame:
    """Status per node from the states of its streams ``flushes``, ``drops`` and ``feeds``
    (feed health keyed by node and exchange), each as of its own last micro-batch."""
    return pipeline.overall_status(
        read_pipeline_health(spark, paths["flushes"], events["flushes"]),
        read_saturation(spark, paths["drops"], events["drops"]),
        read_feed_health(spark, paths["feeds"], events["feeds"], ["node_id", "exchange"]),
        database_ok,
    )
