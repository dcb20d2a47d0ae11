"""Event stream to trades table, one idempotent write per micro-batch."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradelake import schemas
from tradelake.operators.reads import route_trades
from tradelake.sources.table import TradeTable
from tradelake.streaming.outcomes import FlushLog
from tradelake.streaming.state import query_id

FLUSH_INTERVAL_MS = 120_000


def events_from_files(
    spark: SparkSession, path: str, files_per_batch: int = 1_000
) -> DataFrame:
    """Market events from a landing folder of Parquet files."""
    return (
        spark.readStream.schema(schemas.MARKET_EVENTS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def parse_events(messages: DataFrame) -> DataFrame:
    """Events from JSON text in ``value``; what is no event stays as ``unparsed``."""
    text = F.col("value").cast("string")
    parsed = messages.select(
        text.alias("_text"), F.from_json(text, schemas.MARKET_EVENTS).alias("event")
    )
    bad = F.col("event").isNull() | F.col("event.kind").isNull()
    unparsed = F.when(bad, F.coalesce("_text", F.lit(""))).alias("unparsed")
    return parsed.select("event.*", unparsed)


def events_from_kafka(
    spark: SparkSession, brokers: str, topics: list[str], rows_per_batch: int = 10_000_000
) -> DataFrame:
    """Market events from one topic per venue, as JSON. Needs the Kafka package."""
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", ",".join(topics))
        .option("maxOffsetsPerTrigger", rows_per_batch)
        .load()
    )
    return parse_events(source)


def merge_streams(*venues: DataFrame) -> DataFrame:
    """All venues' events as one stream."""
    merged = venues[0]
    for venue in venues[1:]:
        merged = merged.unionByName(venue)
    return merged


def dead_letters(spark: SparkSession, table: TradeTable) -> DataFrame:
    """Messages that were no events, with the query and batch they came with."""
    return spark.read.schema("unparsed string, query string, batch bigint").parquet(
        f"{table.root}/dead"
    )


def start_ingest(
    events: DataFrame,
    table: TradeTable,
    checkpoint: str,
    flush_interval_ms: int = FLUSH_INTERVAL_MS,
    until_caught_up: bool = False,
    log: FlushLog | None = None,
    give_up_after: int | None = None,
) -> StreamingQuery:
    """Store the trades of an event stream; messages that are no events are kept apart.

    Offsets are committed only after a batch is written, and a batch that is retried
    overwrites its own folder, which is named by the query and the batch: nothing is
    lost or stored twice, whichever streams write to the table.

    ``log`` keeps what became of every batch. A batch that has failed
    ``give_up_after`` times is left out of the table and counted as lost, so that one
    that can never be written does not hold up the rest; it needs a log.
    """
    if give_up_after is not None and log is None:
        raise ValueError("give_up_after needs a log to count attempts in")

    def store(batch: DataFrame, batch_id: int) -> None:
        source = query_id(batch.sparkSession, checkpoint)
        if log is None:
            write(batch, batch_id, source)
            return
        try:
            log.stored(source, batch_id, write(batch, batch_id, source))
        except Exception as error:
            final = give_up_after is not None and log.attempts(source, batch_id) + 1 >= give_up_after
            # A query runs its batches in a job group named by its run.
            run = batch.sparkSession.sparkContext.getLocalProperty("spark.jobGroup.id")
            log.failed(source, batch_id, run, _trades_in(batch), str(error), final)
            if not final:
                raise

    def write(batch: DataFrame, batch_id: int, source: str) -> int:
        if "unparsed" in batch.columns:
            dead = batch.filter("unparsed IS NOT NULL").select("unparsed")
            dead.write.mode("overwrite").parquet(
                f"{table.root}/dead/query={source}/batch={batch_id}"
            )
        return table.append(route_trades(batch), batch_id, int(time.time() * 1000), source)

    trigger = (
        {"availableNow": True}
        if until_caught_up
        else {"processingTime": f"{max(flush_interval_ms, 1)} milliseconds"}
    )
    query = (
        events.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    if log is not None:
        log.follow(query)
    return query


def _trades_in(batch: DataFrame) -> int:
    """Trades of a batch that could not be written; 0 where it cannot even be read."""
    try:
        return route_trades(batch).count()
    except Exception:
        return 0
