"""Streaming forms over several micro-batches against sequential code."""

from __future__ import annotations

import random

import pytest

import folds
from tradelake.operators import access, bounds
from tradelake.sources.files import Files
from tradelake.streaming import access as access_stream
from tradelake.streaming import health
from tradelake.streaming import pairs as pairs_stream
from tradelake.streaming.keyed import KeyedState
from tradelake.streaming.state import BatchState

ACCESS = "seq bigint, node_id int, client int, at_ms bigint, kind string"


@pytest.fixture
def landed(spark, scratch):
    """Three files of access events, in time order, read one per micro-batch."""
    rng = random.Random(1)
    kinds = list(access.COUNTERS)
    at, rows = 0, []
    for seq in range(900):
        at += rng.randrange(400)
        key = 0 if rng.random() < 0.4 else rng.randrange(5)
        rows.append((seq, key, key, at, rng.choice(kinds)))
    path = f"{scratch}/landing"
    for low in range(0, 900, 300):
        part = spark.createDataFrame(rows[low : low + 300], ACCESS)
        part.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(ACCESS).option("maxFilesPerTrigger", 1).parquet(path)
    return stream, rows


def by_key(rows, key):
    groups = {}
    for row in rows:
        groups.setdefault(row[key], []).append(row)
    return groups


def test_limiter_state_lasts_over_batches(spark, scratch, landed):
    stream, rows = landed
    run = access_stream.start_rate_limit(stream, f"{scratch}/out", f"{scratch}/offsets", 5, 3_000)
    run.awaitTermination()
    assert len(run.recentProgress) >= 3
    answers = access_stream.read_answers(spark, f"{scratch}/out", "seq bigint, allowed boolean")
    found = {r["seq"]: r["allowed"] for r in answers.collect()}
    assert len(found) == len(rows)
    for group in by_key(rows, 2).values():
        flags = folds.bucket([row[3] for row in group], 5, 3_000)
        assert [found[row[0]] for row in group] == flags


def limited(spark, scratch, batches, capacity, window, **options):
    """Flags of requests (seq, client, at_ms) that arrive in batches, with restarts."""
    schema = "seq bigint, client int, at_ms bigint"
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(schema).parquet(f"{scratch}/in")
        access_stream.start_rate_limit(
            stream, f"{scratch}/out", f"{scratch}/offsets", capacity, window, **options
        ).awaitTermination()
    answers = access_stream.read_answers(spark, f"{scratch}/out", "seq bigint, allowed boolean")
    return {r["seq"]: r["allowed"] for r in answers.collect()}


def test_a_late_request_finds_the_bucket_as_it_is(spark, scratch):
    """Two tokens, one used at 100; a request of 95 that comes later takes the other."""
    batches = [[(0, 1, 100)], [(1, 1, 95), (2, 1, 96)], [(3, 1, 149), (4, 1, 150)]]
    found = limited(spark, scratch, batches, 2, 100)
    assert found == {0: True, 1: True, 2: False, 3: False, 4: True}


def known_clients(spark, path):
    state = KeyedState(spark, f"{path}/out/state", "client", "int", 1_000)
    return sorted(r["client"] for r in state.read().collect())


def test_silent_clients_are_forgotten(spark, scratch):
    """The state is as of the last question, before that batch's own answers."""
    batches = [[(0, 1, 0), (1, 2, 0)], [(2, 2, 5_000)], [(3, 1, 5_001)], [(4, 3, 5_100)]]
    found = limited(spark, scratch, batches, 1, 100, idle_ms=1_000)
    assert all(found.values())
    assert known_clients(spark, scratch) == [1, 2]
    batches = [[(0, 1, 0), (1, 2, 0)], [(2, 2, 5_000)], [(3, 3, 5_001)]]
    limited(spark, f"{scratch}/other", batches, 1, 100, idle_ms=1_000)
    assert known_clients(spark, f"{scratch}/other") == [2]
    with pytest.raises(ValueError, match="full after"):
        limited(spark, f"{scratch}/bad", batches, 1, 1_001, idle_ms=1_000)


def test_a_null_client_has_a_state_too(spark, scratch):
    batches = [[(0, None, 0), (1, 4, 0)], [(2, None, 10), (3, 4, 20)], [(4, None, 50), (5, None, 101)]]
    found = limited(spark, scratch, batches, 1, 100)
    assert found == {0: True, 1: True, 2: False, 3: False, 4: False, 5: True}


STATES = "client int, open bigint, last bigint, seen map<string, bigint>"


def test_states_are_told_once_and_follow_the_batch(spark, scratch):
    """A batch writes its own keys, whatever the number of keys that are known."""

    def state():
        return KeyedState(spark, f"{scratch}/state", "client", "int", 1 << 40)

    def asked(rows, batch):
        df = spark.createDataFrame(rows, "client int, at_ms bigint")
        return {r["client"]: (r["open"], r["last"], r["seen"]) for r in state().ask(df, "q", batch).collect()}

    def told(rows, batch):
        state().tell(spark.createDataFrame(rows, STATES), "q", batch)

    def stored():
        return Files(spark, scratch).size(f"{scratch}/state/store/state")

    assert asked([(i, 10) for i in range(20_000)], 0) == {}
    told([(i, i, 10, {}) for i in range(20_000)], 0)
    assert state().is_done("q", 0) and not state().is_done("q", 1)
    assert asked([(7, 5), (-1, 5)], 1) == {7: (7, 10, {})}
    large = stored()
    # The same question again, as after a failure: the same answer.
    assert asked([(7, 5), (-1, 5)], 1) == {7: (7, 10, {})}
    told([(7, 9, 12, {"a": 1, "b": 2}), (7, 9, 11, {"b": 3})], 1)
    assert asked([(7, 5)], 2) == {7: (9, 12, {"a": 1, "b": 3})}
    # An earlier state that comes later only moves the last time; a later one replaces.
    told([(7, 8, 30, {"a": 9})], 2)
    assert asked([(7, 5)], 3) == {7: (9, 30, {"a": 1, "b": 3})}
    told([(7, 11, 31, {"c": 1})], 3)
    assert asked([(7, 5)], 4) == {7: (11, 31, {"c": 1})}
    assert stored() - large < large / 4
    assert len(Files(spark, scratch).children(f"{scratch}/state/inbox")) <= 3


def test_sample_state_lasts_over_batches(spark, scratch, landed):
    stream, rows = landed
    access_stream.start_access_sample(
        stream, f"{scratch}/out", f"{scratch}/offsets", 0, 5_000, 2
    ).awaitTermination()
    found = access_stream.read_answers(
        spark, f"{scratch}/out", "seq bigint, window_start_ms bigint, nth bigint"
    ).collect()
    wanted = []
    for group in by_key(rows, 1).values():
        wanted += folds.sample([(row[3], row[0], row[4]) for row in group], 0, 5_000, 2)
    assert sorted((r["seq"], r["window_start_ms"], r["nth"]) for r in found) == sorted(wanted)


def test_summary_counts_open_intervals_and_late_events(spark, scratch, landed):
    stream, rows = landed
    access_stream.start_summary(
        stream, f"{scratch}/out", f"{scratch}/offsets", 50_000, 10_000
    ).awaitTermination()
    late = [(5_000 + i, 1, 1, i, "rate_limited") for i in range(-5, 20)]
    spark.createDataFrame(late, ACCESS).write.mode("append").parquet(f"{scratch}/landing")
    stream = spark.readStream.schema(ACCESS).parquet(f"{scratch}/landing")
    access_stream.start_summary(
        stream, f"{scratch}/out", f"{scratch}/offsets", 50_000, 10_000
    ).awaitTermination()
    found = access_stream.read_summary(spark, f"{scratch}/out", stream)
    batch = access.access_summary(spark.createDataFrame(rows + late, ACCESS), 50_000, 10_000)
    assert sorted(map(tuple, found.select(*batch.columns).collect())) == sorted(
        map(tuple, batch.collect())
    )
    assert batch.filter("interval_start_ms = -10000").count() == 1


def test_intervals_are_written_once_and_late_events_correct_them(spark, scratch):
    """Four batches; late events come after their interval has been closed."""
    def rows(*times):
        return [(at, at % 2, 0, at, "rate_limited") for at in times]

    batches = [rows(*range(1_000, 9_000, 500)), rows(*range(20_000, 26_000, 500)), rows(1_500, 3_001, 25_000, 29_000), rows(21_000, 60_000)]
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, ACCESS).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(ACCESS).parquet(f"{scratch}/in")
        access_stream.start_summary(
            stream, f"{scratch}/out", f"{scratch}/offsets", 0, 2_000, late_ms=3_000
        ).awaitTermination()
        so_far = [row for some in batches[: number + 1] for row in some]
        found = access_stream.read_summary(spark, f"{scratch}/out", stream)
        wanted = access.access_summary(spark.createDataFrame(so_far, ACCESS), 0, 2_000)
        assert sorted(map(tuple, found.select(*wanted.columns).collect())) == sorted(map(tuple, wanted.collect()))
    parts = access_stream.written_intervals(spark, f"{scratch}/out", stream)
    closed = parts.filter("NOT late").groupBy("node_id", "interval_start_ms").count()
    assert closed.count() == 9 and closed.filter("count > 1").count() == 0
    late = {(r["node_id"], r["interval_start_ms"]): r["rate_limited"] for r in parts.filter("late").collect()}
    # 21,000 came when all before 26,000 was closed; 25,000 came in time.
    assert late == {(0, 0): 1, (1, 2_000): 1, (0, 20_000): 1}
    left = access_stream.open_intervals(spark, f"{scratch}/out", stream)
    assert [(r["interval_start_ms"], r["rate_limited"]) for r in left.collect()] == [(60_000, 1)]


FEED = "seq bigint, exchange int, at_ms bigint, kind string, reason string"


def test_feed_health_over_batches(spark, scratch):
    rng = random.Random(2)
    kinds = ["connected", "disconnected", "restarting", "stopped", "data"]
    rows = [
        (seq, 0 if rng.random() < 0.4 else rng.randrange(4), seq // 3, rng.choice(kinds), str(seq))
        for seq in range(600)
    ]
    for low in range(0, 600, 150):
        part = spark.createDataFrame(rows[low : low + 150], FEED)
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/landing")
    stream = (
        spark.readStream.schema(FEED)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{scratch}/landing")
    )
    health.start_feed_health(
        stream, f"{scratch}/health", f"{scratch}/offsets"
    ).awaitTermination()
    assert len(BatchState(spark, f"{scratch}/health")._names()) == 2
    found = {
        r["exchange"]: r.asDict()
        for r in health.read_feed_health(spark, f"{scratch}/health", stream).collect()
    }
    for key, group in by_key(rows, 1).items():
        wanted = folds.feed([(row[2], row[0], row[3], row[4]) for row in group])
        assert {name: found[key][name] for name in wanted} == wanted


def test_feed_health_goes_on_with_a_new_checkpoint(spark, scratch):
    for number, kind in enumerate(["connected", "data", "stopped"]):
        path = f"{scratch}/landing{number // 2}"
        spark.createDataFrame([(number, 1, number, kind, "why")], FEED).write.mode("append").parquet(path)
        stream = spark.readStream.schema(FEED).parquet(path)
        health.start_feed_health(
            stream, f"{scratch}/health", f"{scratch}/offsets{number // 2}"
        ).awaitTermination()
    row = health.read_feed_health(spark, f"{scratch}/health", stream).first()
    assert (row["state"], row["connected_at"], row["last_error"]) == ("stopped", 0, "why")


def test_states_are_kept_by_batch(spark, scratch):
    state = BatchState(spark, f"{scratch}/state")
    schema = "n bigint"
    one = spark.createDataFrame([(1,)], schema)

    def add(before):
        return before.unionByName(one)

    assert state.read(schema).count() == 0
    for query, batch in [("q", 0), ("q", 1), ("q", 1), ("q", 2), ("r", 0), ("r", 0), ("q", 3)]:
        state.fold(query, batch, schema, add)
    assert state.read(schema).count() == 5
    with pytest.raises(RuntimeError, match="missing"):
        state.fold("new", 4, schema, add)


def test_live_pairs_follow_the_stream_and_the_configuration(spark, scratch):
    trades = [("Binance Spot", "btcusdt", ts) for ts in (50, 70, 10, 90)] + [("Okex Spot", "x", 5)]
    configured = [(1, "Binance Spot", "BTCUSDT", None), (2, "Okex Spot", "Y", None)]
    schema = "exchange string, symbol string, ts bigint"
    wanted = "pos int, exchange string, symbol string, display_symbol string"
    offsets = f"{scratch}/offsets"
    assert pairs_stream.live_bounds(spark, offsets).count() == 0
    for n in range(len(trades)):
        spark.createDataFrame(trades[n : n + 1], schema).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(schema).parquet(f"{scratch}/in")
        pairs_stream.start_pair_bounds(stream, offsets, until_caught_up=True).awaitTermination()
        now = spark.createDataFrame(configured[: 1 + n % 2], wanted)
        found = pairs_stream.live_pairs(spark, offsets, now).collect()
        so_far = spark.createDataFrame(trades[: n + 1], schema)
        assert found == bounds.configured_pairs(now, bounds.pair_bounds(so_far)).collect()
    assert found[0]["earliest"] == 10 and found[0]["latest"] == 90
