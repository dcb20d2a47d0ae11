from __future__ import annotations

import random

import pytest

from tradelake.operators import cuts, retention
from tradelake.operators.ordered import repeat_rows, running_total
from tradelake.operators.reads import TradeQuery, read_trades
from tradelake.schemas import TRADE_COLUMNS, TRADES
from tradelake.sources.table import MetadataTable, TradeTable

DAY = 86_400_000
MIB = 1024 * 1024


def trades(spark, rows):
    return spark.createDataFrame(rows, TRADES)


def some_rows(seed, n=400, span=30):
    """Few times and few prices, so that ties and full copies abound."""
    rng = random.Random(seed)
    return [
        (rng.choice("ab"), rng.choice("xy"), rng.randrange(span), rng.choice([1.0, 2.0]), 1.0,
         rng.random() < 0.5)
        for _ in range(n)
    ]


def oldest_first(rows):
    return sorted(rows, key=lambda r: (r[2], r[0], r[1], r[3], r[4], r[5]))


@pytest.mark.parametrize("n", [0, 1, 7, 133, 399, 400, 500])
def test_cut_splits_ties_and_copies_exactly(spark, n):
    rows = some_rows(1)
    df = trades(spark, rows)
    kept = [tuple(r) for r in retention.purge_keep(df, n).collect()]
    gone = [tuple(r) for r in retention.oldest_trades(df, n).collect()]
    assert sorted(kept) == sorted(oldest_first(rows)[n:])
    assert sorted(gone) == sorted(oldest_first(rows)[:n])


def test_one_group_of_copies_may_be_most_rows(spark):
    rows = [("a", "x", 5, 1.0, 1.0, True)] * 9_000 + some_rows(2, 50, 20)
    kept = retention.purge_keep(trades(spark, rows), 4_000)
    assert sorted(tuple(r) for r in kept.collect()) == sorted(oldest_first(rows)[4_000:])


def test_cut_narrows_over_several_passes(spark):
    rng = random.Random(3)
    times = [rng.randrange(10**12) for _ in range(300)]
    df = trades(spark, [("a", "x", t, 1.0, 1.0, True) for t in times])
    assert cuts.time_cut(df, 120).ts == sorted(times)[119]
    assert cuts.time_cut(df, 120, newest=True).ts == sorted(times)[-120]
    assert cuts.time_cut(df, 301, newest=True) is None
    assert cuts.time_cut(df.limit(0), 1) is None


def test_running_total_and_repeat(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS v")
    rows = running_total(df, ["id"], "v").orderBy("id").collect()
    total = 0
    for row in rows:
        assert row["before"] == total
        total += row["v"]
    counts = repeat_rows(df.filter("id < 7"), df.v * 3_000).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in counts} == {i: i * 3_000 for i in range(1, 7)}


def test_retention_is_strict_and_zero_hours_keeps_all(spark):
    df = trades(spark, [("a", "x", ts, 1.0, 1.0, True) for ts in (99, 100, 101, 10**15)])
    now = 100 + 3_600_000
    assert sorted(r["ts"] for r in retention.retention_keep(df, now, 1).collect()) == [
        100, 101, 10**15,
    ]
    assert retention.retention_deleted(df, now, 1).first()[0] == 1
    assert retention.retention_keep(df, now, 0).count() == 4
    assert retention.retention_deleted(df, now, 0).first()[0] == 0


@pytest.mark.parametrize(
    ("size", "rows", "cap", "per_row", "gone"),
    [
        # Below the target nothing goes, however many rows there are.
        (100, 10**9, 100, 1, 0),
        # 150 MiB of 50-byte rows, cap 100 MiB: a third goes.
        (150, 150 * MIB // 50, 100, 50, 150 * MIB // 50 - 100 * MIB // 50),
        # A cap of 1,000 MiB leaves 800; rows count 10 bytes here.
        (1_200, 1_200 * MIB // 10, 1_000, 10, 1_200 * MIB // 10 - 800 * MIB // 10),
        # Wide rows count 50 bytes at most, so fewer rows than that stay as they are.
        (200, 1_000, 100, 50, 0),
        (200, 0, 100, 50, 0),
    ],
)
def test_purge_plan_reaches_the_target_at_once(spark, size, rows, cap, per_row, gone):
    df = spark.createDataFrame(
        [(size * MIB, rows, cap * MIB)], "size_bytes bigint, row_count bigint, cap_bytes bigint"
    )
    row = retention.with_purge_plan(df).first()
    assert (row["bytes_per_row"], row["to_delete"]) == (per_row, gone)
    assert row["row_count"] - row["to_delete"] <= max(row["max_rows"], row["row_count"] * (gone == 0))


@pytest.mark.parametrize(
    ("cap", "target"), [(50, 50), (100, 100), (125, 100), (60 * 1024, 50 * 1024)]
)
def test_purge_target(spark, cap, target):
    df = spark.createDataFrame(
        [(0, 0, cap * MIB)], "size_bytes bigint, row_count bigint, cap_bytes bigint"
    )
    assert retention.with_purge_plan(df).first()["target_bytes"] == target * MIB


def test_startup_guard_bounds_are_strict():
    assert retention.check_startup_size(100, 100) is False
    assert retention.check_startup_size(101, 100) is True
    assert retention.check_startup_size(200, 100) is True
    with pytest.raises(ValueError, match="twice"):
        retention.check_startup_size(201, 100)


def stored(spark, root, days=6, per_day=50):
    table = TradeTable(spark, f"{root}/table")
    rows = [
        ("Binance Spot" if i % 3 else "Okex Linear", "xy"[i % 2], day * DAY + i * 1_000_000,
         float(i), 1.0, True)
        for day in range(days)
        for i in range(per_day)
    ]
    table.append(trades(spark, rows), 0, 1)
    table.settle()
    return table, rows


def rows_of(table):
    return sorted(tuple(r) for r in table.read().select(*TRADE_COLUMNS).collect())


def test_cleanup_pass_on_the_stored_table(spark, scratch, monkeypatch):
    table, rows = stored(spark, scratch)
    metadata = MetadataTable(spark, f"{scratch}/metadata")
    assert metadata.get("last_cleanup") is None
    cutoff = 2 * DAY + 7_000_000
    now = cutoff + 24 * 3_600_000
    done = retention.run_cleanup(table, metadata, now, 24)
    left = [r for r in rows if r[2] >= cutoff]
    assert done == retention.CleanupResult(len(rows) - len(left), None)
    assert rows_of(table) == sorted(left)
    assert metadata.get("last_cleanup") == str(now)
    assert metadata.get("tls_domain") is None

    # The size rule at test size: a small floor, the same arithmetic.
    monkeypatch.setattr(retention, "MIN_TARGET", 1)
    aged = [r for r in left if r[2] >= cutoff + 1]
    cap = 25 * len(aged)
    n = len(aged) - (cap - cap // 5) // 50
    done = retention.run_cleanup(table, metadata, now + 1, 24, cap, 50)
    assert done == retention.CleanupResult(len(left) - len(aged), n)
    assert rows_of(table) == sorted(oldest_first(aged)[n:])
    bounds = {(r[0], r[1]): (r[2], r[3]) for r in table.read_bounds().collect()}
    wanted = {}
    for r in rows_of(table):
        low, high = wanted.get(r[:2], (r[2], r[2]))
        wanted[r[:2]] = min(low, r[2]), max(high, r[2])
    assert bounds == wanted
    # Now it is at its target, and the next pass finds nothing to do.
    assert retention.run_cleanup(table, metadata, now + 1, 24, cap, 50).deleted_by_size == 0


def test_size_rule_uses_the_stored_size(spark, scratch, monkeypatch):
    table, rows = stored(spark, scratch)
    monkeypatch.setattr(retention, "MIN_TARGET", 1)
    size = table.stored_bytes()
    assert size > 0
    assert retention.purge_by_size(table, 2 * size) == 0
    n = retention.purge_by_size(table, size // 4)
    assert 0 < n < len(rows)
    assert rows_of(table) == sorted(oldest_first(rows)[n:])


def test_only_the_boundary_period_is_rewritten(spark, scratch):
    table, rows = stored(spark, scratch)
    kept = table.periods()[-2:]
    files = {str(day): table._files().children(f"{table.data}/dt={day}") for day in kept}
    assert retention.purge_by_size(table, 130 * 50, 50) == len(rows) - 130
    assert len(table.periods()) == 3
    assert {str(day): table._files().children(f"{table.data}/dt={day}") for day in kept} == files


def test_a_table_far_above_its_cap_is_refused_at_startup(spark, scratch):
    table, rows = stored(spark, scratch, days=1)
    metadata = MetadataTable(spark, f"{scratch}/metadata")
    cap = table.stored_bytes() // 3
    with pytest.raises(ValueError, match="twice"):
        retention.run_cleanup(table, metadata, DAY, 0, cap, at_startup=True)
    assert rows_of(table) == sorted(rows)
    assert metadata.get("last_cleanup") is None


def test_cutoff_may_fall_into_a_gap(spark, scratch):
    table, rows = stored(spark, scratch, days=2)
    metadata = MetadataTable(spark, f"{scratch}/metadata")
    table.append(trades(spark, [("Okex Linear", "x", 9 * DAY, 1.0, 1.0, True)]), 1, 2)
    assert retention.run_cleanup(table, metadata, 5 * DAY + 3_600_000, 1).deleted_by_age == len(rows)
    assert [row[2] for row in rows_of(table)] == [9 * DAY]
    # A pass that deletes every row leaves an empty table that can be read.
    assert retention.run_cleanup(table, metadata, 99 * DAY, 1).deleted_by_age == 1
    assert rows_of(table) == []


def test_late_trades_after_a_pass_are_found(spark, scratch):
    table, rows = stored(spark, scratch)
    metadata = MetadataTable(spark, f"{scratch}/metadata")
    cutoff = 3 * DAY + 45_000_000
    retention.run_cleanup(table, metadata, cutoff + 3_600_000, 1)
    late = [("Binance Spot", "x", DAY + 5, 1.0, 1.0, True)]
    table.append(trades(spark, late), 1, 2)
    left = [r for r in rows if r[2] >= cutoff] + late
    assert rows_of(table) == sorted(left)
    bounds = {(r[0], r[1]): r[2] for r in table.read_bounds().collect()}
    wanted = {pair: min(r[2] for r in left if r[:2] == pair) for pair in {r[:2] for r in left}}
    assert bounds == wanted
    for limit in (1, 20, None):
        query = TradeQuery("binance", "x", "spot", from_ms=0, limit=limit)
        assert table.read_trades(query).collect() == read_trades(table.read(), query).collect()


def test_failed_size_rule_still_records_the_pass(spark, scratch, monkeypatch):
    table, _ = stored(spark, scratch, days=1)
    metadata = MetadataTable(spark, f"{scratch}/metadata")

    def broken(*_):
        raise OSError("no")

    monkeypatch.setattr(retention, "purge_by_size", broken)
    assert retention.run_cleanup(table, metadata, DAY, 0, 1) == retention.CleanupResult(0, None)
    monkeypatch.setattr(retention, "purge_by_age", broken)
    assert retention.run_cleanup(table, metadata, 2 * DAY, 0).deleted_by_age is None
    assert metadata.get("last_cleanup") == str(DAY)
