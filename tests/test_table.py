from __future__ import annotations

import pathlib
import random
from collections import Counter

import pytest

from tradelake.functions.times import period_of_ms
from tradelake.operators import bounds, reads
from tradelake.schemas import MARKET_EVENTS, TRADE_COLUMNS, TRADES
from tradelake.sources import table as table_module
from tradelake.sources.table import TradeTable
from tradelake.streaming import ingest

DAY = 86_400_000


def some_trades(spark, seed, n=500, days=12):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["Binance Spot", "Bybit Linear"]), rng.choice(["btcusdt", "ethusdt"]),
         rng.randrange(days * DAY), rng.random(), 1.0, rng.random() < 0.5)
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, TRADES), rows


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*TRADE_COLUMNS).collect())


def test_batches_are_idempotent_and_keep_duplicates(spark, scratch):
    table = TradeTable(spark, scratch)
    df, rows = some_trades(spark, 1)
    table.append(df, 0, 10)
    table.append(df, 1, 20)
    table.append(df, 1, 30)
    for _ in range(2):
        assert rows_of(table.read()) == sorted(rows + rows)
        flushes = table.read_flushes()
        assert flushes.agg({"trades": "sum"}).first()[0] == 1_000
        assert sorted(tuple(r) for r in reads.batch_exchanges(table.read()).collect()) == [
            (0, "Binance Spot"), (0, "Bybit Linear"), (1, "Binance Spot"), (1, "Bybit Linear"),
        ]
        table.settle()


def test_a_replay_after_settling_changes_nothing(spark, scratch):
    table = TradeTable(spark, scratch)
    df, rows = some_trades(spark, 1)
    for batch in range(3):
        table.append(df, batch, 1)
    table.settle()
    table.append(df, 2, 2)
    assert rows_of(table.read()) == sorted(rows * 3)
    table.append(df, 3, 3)
    table.settle()
    table.settle()
    assert rows_of(table.read()) == sorted(rows * 4)
    assert table.read_flushes().agg({"trades": "sum"}).first()[0] == 4 * len(rows)


def test_settling_may_be_cut_short(spark, scratch):
    """Rows are merged, but the batches neither marked nor dropped: nothing doubles."""
    table = TradeTable(spark, scratch)
    df, rows = some_trades(spark, 8)
    table.append(df, 0, 1)
    table.append(df, 1, 1)
    periods = {r[0] for r in table.read().select("dt").distinct().collect()}
    table._rewrite(table._landed_rows(table._landed_names()), sorted(periods))
    assert rows_of(table.read()) == sorted(rows * 2)
    table.settle()
    assert rows_of(table.read()) == sorted(rows * 2)
    assert table._files().children(table.landing) == []


def test_sources_do_not_touch_each_other(spark, scratch):
    table = TradeTable(spark, scratch)
    df, rows = some_trades(spark, 9)
    table.append(df, 0, 1, "one-query")
    table.append(df, 0, 1, "other")
    table.settle()
    table.append(df, 0, 1, "third")
    assert rows_of(table.read()) == sorted(rows * 3)
    wanted = sorted(map(tuple, bounds.pair_bounds(df).collect()))
    assert sorted(map(tuple, table.read_bounds().collect())) == wanted


def test_listed_folders_do_not_grow_with_batches(spark, scratch):
    table = TradeTable(spark, scratch)
    df, _ = some_trades(spark, 10, n=60, days=3)

    def folders():
        files = table._files()
        return sum(len(files.children(f"{scratch}/{part}")) for part in ("data", "flushes", "landing"))

    counts = []
    for batch in range(6):
        table.append(df, batch, 1)
        if batch % 3 == 2:
            table.settle()
            counts.append(folders())
    assert counts[0] == counts[1]
    query = reads.TradeQuery("binance", "btcusdt", "spot", limit=5)
    assert table.for_query(query).select("dt").distinct().count() == 1


def test_rows_with_nulls_are_set_aside(spark, scratch):
    table = TradeTable(spark, scratch)
    rows = [("a", "x", 1, 1.0, 1.0, True), ("a", None, 1, 1.0, 1.0, True),
            ("a", "x", None, 1.0, 1.0, True)]
    table.append(spark.createDataFrame(rows, TRADES), 0, 1)
    for _ in range(2):
        assert table.read().count() == 1
        assert table.read_rejects().count() == 2
        table.settle()


def test_empty_table(spark, scratch):
    table = TradeTable(spark, scratch)
    query = reads.TradeQuery("binance", "x", "spot")
    table.settle()
    assert table.read().count() == table.read_trades(query).count() == 0
    assert table.stored_bytes() == 0
    assert table.read_bounds().count() == 0
    assert table.read_flushes().count() == 0
    assert table.read_rejects().count() == 0
    table.append(spark.createDataFrame([], TRADES), 0, 1)
    table.settle()
    assert table.read().count() == 0


@pytest.mark.parametrize("period", ["day", "month", "year"])
def test_periods(spark, scratch, period):
    table = TradeTable(spark, scratch, period)
    df, rows = some_trades(spark, 2, n=60, days=800)
    table.append(df, 0, 1)
    table.settle()
    assert table.periods() == sorted({period_of_ms(r[2], period) for r in rows})
    assert rows_of(table.between(100 * DAY, 500 * DAY)) == sorted(
        r for r in rows if 100 * DAY <= r[2] <= 500 * DAY
    )


@pytest.mark.parametrize("limit", [1, 40, None])
@pytest.mark.parametrize("low", [None, 3 * DAY + 5])
@pytest.mark.parametrize("high", [None, 8 * DAY + 5])
def test_narrowed_reads_equal_whole_reads(spark, scratch, limit, low, high):
    table = TradeTable(spark, scratch)
    df, _ = some_trades(spark, 3)
    even = df.ts % 2 == 0
    table.append(df.filter(even), 0, 1)
    table.settle()
    table.append(df.filter(~even), 1, 1)
    query = reads.TradeQuery("binance", "BTCUSDT", "spot", low, high, limit)
    assert table.read_trades(query).collect() == reads.read_trades(df, query).collect()


def test_narrowed_read_touches_few_periods(spark, scratch):
    table = TradeTable(spark, scratch)
    df, _ = some_trades(spark, 4)
    table.append(df, 0, 1)
    table.settle()
    query = reads.TradeQuery("binance", "btcusdt", "spot", limit=5)
    touched = table.for_query(query).select("dt").distinct().count()
    assert touched == 1 < len(table.periods())


def test_bounds_come_from_the_flush_log(spark, scratch):
    table = TradeTable(spark, scratch)
    df, _ = some_trades(spark, 5)
    table.append(df, 0, 1)
    table.settle()
    table.drop_period(table.periods()[0])
    wanted = sorted(map(tuple, bounds.pair_bounds(table.read()).collect()))
    assert sorted(map(tuple, table.read_bounds().collect())) == wanted


def test_settling_merges_files(spark, scratch):
    table = TradeTable(spark, scratch)
    df, rows = some_trades(spark, 6, days=1)
    for batch in range(4):
        table.append(df, batch, batch)
    table.settle()
    [day] = table.periods()
    assert rows_of(table.read()) == sorted(rows * 4)
    files = table._files().children(f"{table.data}/dt={day}")
    assert len([name for name in files if name.startswith("part-")]) < 4
    flushes = table.read_flushes().collect()
    assert sum(r["trades"] for r in flushes) == len(rows) * 4
    assert {r["flushed_at"] for r in flushes} == {3}
    assert len(flushes) == 4


def test_files_prune_by_period_exchange_symbol_and_time(spark, scratch):
    table = TradeTable(spark, scratch)
    df, _ = some_trades(spark, 7)
    table.append(df, 0, 1)
    table.settle()
    query = reads.TradeQuery("binance", "btcusdt", "spot", 2 * DAY, 4 * DAY)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2_000)
    plan = table.read_trades(query)._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(exchange,Binance Spot)" in plan
    assert "EqualTo(symbol,btcusdt)" in plan
    assert f"GreaterThanOrEqual(ts,{2 * DAY})" in plan
    assert table.for_query(query).select("dt").distinct().count() <= 3


def event(seq, kind, trades):
    return (seq, seq, "Binance Spot", kind, trades)


def test_streaming_ingest_over_batches_and_restart(spark, scratch):
    landing = f"{scratch}/landing"
    table = TradeTable(spark, f"{scratch}/table")

    def land(number):
        one = [("@1", "BTCUSDT", number, 1.0, 1.0, True), ("ETHUSDT", None, number, 2.0, 1.0, False)]
        events = [event(number, "trades", one), event(number, "depth", one),
                  event(number, "connected", [])]
        spark.createDataFrame(events, MARKET_EVENTS).coalesce(1).write.mode("append").parquet(
            landing
        )

    def run():
        stream = ingest.events_from_files(spark, landing, files_per_batch=1)
        ingest.start_ingest(
            stream, table, f"{scratch}/offsets", until_caught_up=True
        ).awaitTermination()

    for number in range(3):
        land(number)
    run()
    assert table.read().select("batch_id").distinct().count() == 3
    table.settle()
    land(3)
    run()
    run()
    wanted = [("Binance Spot", "btcusdt", i, 1.0, 1.0, True) for i in range(4)]
    wanted += [("Binance Spot", "ethusdt", i, 2.0, 1.0, False) for i in range(4)]
    assert rows_of(table.read()) == sorted(wanted)


def test_a_new_checkpoint_loses_and_replaces_nothing(spark, scratch):
    """Batches are numbered from 0 again, but they are another query's batches."""
    table = TradeTable(spark, f"{scratch}/table")
    for number in range(2):
        trade = [("@1", "BTCUSDT", number, 1.0, 1.0, True)]
        landing = f"{scratch}/landing{number}"
        spark.createDataFrame([event(number, "trades", trade)], MARKET_EVENTS).write.parquet(landing)
        ingest.start_ingest(
            ingest.events_from_files(spark, landing), table, f"{scratch}/offsets{number}", until_caught_up=True
        ).awaitTermination()
        if number == 0:
            table.settle()
    assert sorted(r["ts"] for r in table.read().collect()) == [0, 1]
    assert table.read_flushes().agg({"trades": "sum"}).first()[0] == 2


def test_messages_that_are_no_events_are_kept(spark, scratch):
    good = '{"seq":1,"at_ms":1,"exchange":"a","kind":"trades","trades":[{"ticker":"x","ts":5,"price":1.0,"qty":2.0,"is_sell":true}]}'
    bad = ["{", "", "[]", '{"seq":1}', "null", good[:60]]
    rows = spark.createDataFrame([(v,) for v in [good, *bad, None]], "value string")
    parsed = ingest.parse_events(rows).collect()
    assert sorted(r["unparsed"] for r in parsed if r["unparsed"] is not None) == sorted([*bad, ""])
    assert [r["kind"] for r in parsed if r["unparsed"] is None] == ["trades"]


def files_of(table):
    """Data files of every period with their sizes."""
    found = {}
    for start in table.periods():
        folder = pathlib.Path(f"{table.data}/dt={start}".removeprefix("file:"))
        found |= {(start, p.name): p.stat().st_size for p in folder.glob("*.parquet")}
    return found


def spread(spark, days, per_day, price):
    """Trades of one pair, ``per_day`` a day."""
    return spark.range(days * per_day).selectExpr(
        "'Binance Spot' AS exchange", "'btcusdt' AS symbol",
        f"id div {per_day} * 86400000L + id % {per_day} AS ts",
        f"CAST({price} + id AS double) AS price", "1.0D AS qty", "false AS is_sell",
    )


def test_late_trades_add_files(spark, scratch):
    """One late trade in every period: the files that are there stay as they are."""
    table = TradeTable(spark, f"{scratch}/table")
    table.append(spread(spark, 6, 5_000, 0), 0, 1)
    table.settle()
    before = files_of(table)
    assert len({start for start, _ in before}) == 6
    table.append(spread(spark, 6, 1, 0.5), 1, 2)
    table.settle()
    after = files_of(table)
    assert before.items() <= after.items()
    assert sum(after.values()) - sum(before.values()) < sum(before.values()) / 10
    assert table.read().count() == 6 * 5_001
    counts = table.read_flushes().groupBy("dt").agg({"trades": "sum"}).collect()
    assert sorted(r[1] for r in counts) == [5_001] * 6
    bounds = table.read_bounds().first()
    assert (bounds["earliest"], bounds["latest"]) == (0, 5 * 86_400_000 + 4_999)


def test_a_settle_that_was_cut_short_is_done_again(spark, scratch, monkeypatch):
    table = TradeTable(spark, f"{scratch}/table")
    table.append(spread(spark, 3, 100, 0), 0, 1)
    table.settle()
    table.append(spread(spark, 3, 10, 0.5), 1, 2)
    wanted = sorted(map(tuple, table.read().select("ts", "price").collect()))
    stored = TradeTable._store

    def fail(rows, path, *rest):
        if path == table.flushes:
            raise RuntimeError("stopped")
        stored(rows, path, *rest)

    monkeypatch.setattr(TradeTable, "_store", staticmethod(fail))
    for _ in range(2):
        with pytest.raises(RuntimeError, match="stopped"):
            table.settle()
        assert sorted(map(tuple, table.read().select("ts", "price").collect())) == wanted
    monkeypatch.undo()
    for _ in range(2):
        table.settle()
        assert sorted(map(tuple, table.read().select("ts", "price").collect())) == wanted
        assert table.read_flushes().agg({"trades": "sum"}).first()[0] == 330
        assert {r["batch_id"] for r in table.read().select("batch_id").distinct().collect()} == {0, 1}


def test_periods_of_many_files_are_rewritten(spark, scratch, monkeypatch):
    monkeypatch.setattr(table_module, "MANY_FILES", 3)
    table = TradeTable(spark, f"{scratch}/table")
    most = 0
    for batch in range(7):
        table.append(spread(spark, 2, 3, batch * 10), batch, batch)
        table.settle()
        per_period = Counter(start for start, _ in files_of(table))
        most = max(most, *per_period.values())
    assert most == 3
    assert table.read().count() == 7 * 6
    assert table.read_flushes().agg({"trades": "sum"}).first()[0] == 7 * 6
