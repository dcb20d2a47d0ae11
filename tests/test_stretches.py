"""Cuts of crowded keys: order, size, and the operators that stand on them."""

from __future__ import annotations

import random

import folds
import pytest
from pyspark.sql import functions as F

from tradelake.operators import admission, feeds, flushes
from tradelake.operators.stretches import Stretches

SCHEMA = "client int, at_ms bigint, seq bigint"


def crowds():
    """Keys whose times lie far apart, in bunches within bunches, or all at once."""
    rng = random.Random(9)
    times = {
        1: [0] + [10**12 + rng.randrange(5_000) for _ in range(3_000)],
        2: [10**12 + (rng.randrange(3) * 10**6) + rng.randrange(40) for _ in range(2_000)] + [5, 10**15],
        3: [77] * 2_000,
        4: list(range(2_000)),
        5: [1, 2, 3],
        None: [9] * 700 + [-(10**9)],
    }
    rows, seq = [], 0
    for key, own in times.items():
        for at in own:
            rows.append((key, at, seq))
            seq += 1
    rng.shuffle(rows)
    return rows


def test_chunks_are_small_and_in_order(spark):
    rows = crowds()
    log = spark.createDataFrame(rows, SCHEMA)
    placed = Stretches(log, ["client"], 100).place(log).collect()
    assert sorted(map(tuple, (r[:3] for r in placed)), key=str) == sorted(rows, key=str)
    by_key = {}
    for row in placed:
        by_key.setdefault(row["client"], []).append((row["at_ms"], row["seq"], row["chunk"]))
    for key, own in by_key.items():
        chunks = [chunk for *_, chunk in sorted(own)]
        assert chunks == sorted(chunks)
        sizes = [chunks.count(c) for c in set(chunks)]
        assert max(sizes) <= 200
        assert (len(sizes) == 1) == (key == 5)
    inner = Stretches(log, ["client"], 100).place(log, "inner")
    assert inner.filter("client = 5").count() == 0 and inner.count() == len(rows) - 3


def test_equal_rows_share_a_chunk_and_nothing_is_cut_in_vain(spark):
    log = spark.createDataFrame([(1, 5, 5)] * 500 + [(1, 6, 6)], SCHEMA)
    sizes = Stretches(log, ["client"], 100).place(log).groupBy("chunk").count().collect()
    assert sorted(r["count"] for r in sizes) == [1, 500]
    nothing = Stretches(log.limit(0), ["client"], 100)
    assert nothing.place(log.limit(0)).collect() == []
    few = Stretches(log, ["client"], 1_000)
    assert few.regions == [] and few.place(log).filter("chunk = 0").count() == 501


@pytest.mark.parametrize("capacity,window", [(1, 1_000), (4, 700)])
def test_limits_of_bunched_requests(spark, capacity, window):
    rows = crowds()
    log = spark.createDataFrame(rows, SCHEMA)
    found = {r["seq"]: r["allowed"] for r in admission.rate_limit_flags(log, capacity, window, rows_per_chunk=100).collect()}
    for key in {key for key, *_ in rows}:
        own = sorted((at, seq) for k, at, seq in rows if k == key)
        assert [found[seq] for _, seq in own] == folds.bucket([at for at, _ in own], capacity, window)


def test_health_of_bunched_feeds_and_flushes(spark):
    rng = random.Random(10)
    rows = crowds()
    kinds = ["connected", "disconnected", "restarting", "stopped", "data"]
    events = spark.createDataFrame(
        [(*row, rng.choice(kinds), str(row[2])) for row in rows], f"{SCHEMA}, kind string, reason string"
    ).withColumnRenamed("client", "exchange")
    whole = sorted(map(str, feeds.feed_health(events).collect()))
    parts = feeds.feed_partials(events, ["exchange"], rows_per_stretch=100)
    assert max(r["count"] for r in parts.groupBy("exchange").count().collect()) > 15
    assert sorted(map(str, feeds.health_of(parts, ["exchange"]).collect())) == whole
    flush = spark.createDataFrame(
        [(*row, rng.choice(["ok", "ok", "ok", "failed", "retry_ok", "dropped"]), rng.choice([0, 0, 0, 2]), str(row[2])) for row in rows],
        f"{SCHEMA}, kind string, n bigint, error string",
    ).withColumnRenamed("client", "node_id").filter(F.col("node_id").isNotNull())
    whole = sorted(map(str, flushes.health_of(flushes.flush_partials(flush, ["node_id"]), ["node_id"]).collect()))
    parts = flushes.flush_partials(flush, ["node_id"], rows_per_stretch=100)
    assert sorted(map(str, flushes.health_of(parts, ["node_id"]).collect())) == whole
