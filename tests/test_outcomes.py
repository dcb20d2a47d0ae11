"""What the log says of batches that were written, refused, retried and given up."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException

from tradelake.operators import pipeline
from tradelake.plans.tables import UnreliableTable
from tradelake.schemas import MARKET_EVENTS
from tradelake.streaming import ingest
from tradelake.streaming.outcomes import FlushLog, outcomes, supervise, write_attempts


def event(spark, seq, trades):
    rows = [(f"T{i}", None, 1_000 + i, 1.0, 1.0, False) for i in range(trades)]
    return spark.createDataFrame([(seq, 1_000, "Binance Spot", "trades", rows)], MARKET_EVENTS)


@pytest.fixture
def node(spark, scratch):
    """A node that takes events as they come; gives its log and a way to run it."""
    log = FlushLog(spark, f"{scratch}/outcomes", 7)

    def run(table, restarts=0, **options):
        def start():
            stream = ingest.events_from_files(spark, f"{scratch}/in", files_per_batch=1)
            return ingest.start_ingest(
                stream, table, f"{scratch}/offsets", until_caught_up=True, log=log, **options
            )

        return supervise(start, restarts, pause_s=0, log=log)

    yield log, run
    log.close()


def told(spark, scratch):
    rows = outcomes(spark, f"{scratch}/outcomes").orderBy("batch", "attempt").collect()
    assert len({r["query"] for r in rows}) <= 1 and {r["node_id"] for r in rows} <= {7}
    return [(r["batch"], r["attempt"], r["outcome"], r["n"], r["error"]) for r in rows]


def test_batches_that_are_written(spark, scratch, node):
    for seq in range(3):
        event(spark, seq, seq + 1).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    assert told(spark, scratch) == []
    table = UnreliableTable(spark, f"{scratch}/table")
    node[1](table)
    node[1](table)  # nothing new: nothing to tell
    found = told(spark, scratch)
    assert [row[:3] for row in found] == [(b, 0, "success") for b in range(3)]
    assert sum(row[3] for row in found) == table.read().count() == 6


def test_a_refused_batch_is_retried_before_new_data(spark, scratch, node):
    table = UnreliableTable(spark, f"{scratch}/table", refusals={1: 2})
    event(spark, 0, 2).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    node[1](table)
    event(spark, 1, 3).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    with pytest.raises(StreamingQueryException, match="no space"):
        node[1](table)
    # More arrives before the next attempt; the failed batch keeps its rows.
    event(spark, 2, 4).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    node[1](table, restarts=1)
    why = "no space for batch 1"
    assert told(spark, scratch) == [
        (0, 0, "success", 2, None),
        (1, 0, "failure", 3, why),
        (1, 1, "failure", 3, why),
        (1, 2, "retry_success", 3, None),
        (2, 0, "success", 4, None),
    ]
    assert table.read().count() == 9
    attempts = write_attempts(spark, f"{scratch}/outcomes")
    health = pipeline.pipeline_health(pipeline.flush_outcome_events(attempts)).first()
    assert health["persistence_healthy"] and health["flush_failure_count"] == 2
    times = [r["at_ms"] for r in attempts.orderBy("seq").collect()]
    assert times == sorted(times) and health["last_flush_at"] == times[-1]


def test_a_batch_is_given_up(spark, scratch, node):
    table = UnreliableTable(spark, f"{scratch}/table", refusals={0: 9})
    for seq in range(2):
        event(spark, seq, 5).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    node[1](table, restarts=5, give_up_after=3)
    assert [(b, a, o) for b, a, o, *_ in told(spark, scratch)] == [
        (0, 0, "failure"),
        (0, 1, "failure"),
        (0, 2, "final_failure"),
        (1, 0, "success"),
    ]
    attempts = write_attempts(spark, f"{scratch}/outcomes")
    health = pipeline.pipeline_health(pipeline.flush_outcome_events(attempts)).first()
    assert not health["persistence_healthy"] and health["flush_dropped_trades"] == 5
    assert table.read().count() == 5


def test_a_batch_that_cannot_be_computed_is_reported(spark, scratch, node):
    """A row of the batch cannot be computed: neither written nor counted."""
    log, run = node
    event(spark, 0, 1).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    run(UnreliableTable(spark, f"{scratch}/table"))
    path = f"{scratch}/in"
    stream = ingest.events_from_files(spark, path)
    broken = stream.filter("CASE WHEN seq = 1 THEN raise_error('bad row') ELSE true END")
    event(spark, 1, 1).coalesce(1).write.mode("append").parquet(path)
    query = ingest.start_ingest(
        broken, UnreliableTable(spark, f"{scratch}/table"), f"{scratch}/offsets", until_caught_up=True, log=log
    )
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    log.wait(query)
    found = told(spark, scratch)
    assert [row[:4] for row in found] == [(0, 0, "success", 1), (1, 0, "failure", 0)]
    assert "bad row" in found[1][4]


def test_giving_up_needs_a_log(spark, scratch):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="needs a log"):
        ingest.start_ingest(stream, None, scratch, give_up_after=2)
