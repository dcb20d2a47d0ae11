from __future__ import annotations

import json

import pyarrow as pa
import pytest

from tradelake.operators import bounds, catalog, reads, upserts
from tradelake.schemas import TRADES
from tradelake.sources import exports, whitelist
from tradelake.sources.exchanges import exchange_filter, exchanges


def ramp(spark, n):
    return spark.range(n).selectExpr(
        "'Binance Spot' AS exchange", "'btcusdt' AS symbol", "id AS ts",
        "double(id) AS price", "1.0D AS qty", "id % 2 = 0 AS is_sell",
    )


def test_arrow_streams_hold_all_rows_in_order(spark):
    query = reads.TradeQuery("binance", "btcusdt", "spot")
    export = reads.export_trades(ramp(spark, 25_000), query)
    rows = exports.arrow_streams(export, 1_000, 5_000).orderBy("part").collect()
    tables = [pa.ipc.open_stream(row["stream"]).read_all() for row in rows]
    assert all(table.schema == exports.ARROW_SCHEMA for table in tables)
    assert [row["rows"] for row in rows] == [table.num_rows for table in tables]
    times = [at for table in tables for at in table["ts"].to_pylist()]
    assert times == list(range(24_999, -1, -1))
    streams = exports.arrow_streams(export, 1_000, 5_000)
    assert exports.stream_stats(streams).rows == 25_000
    assert exports.stream_stats(streams).batches >= 25
    assert exports.stream_stats(streams.limit(0)) == exports.ExportStats(0, 0)
    assert exports.read_arrow_streams(streams).count() == 25_000


def test_reads_without_a_limit_return_everything(spark):
    query = reads.TradeQuery("binance", "btcusdt", "spot", from_ms=5)
    times = [row["ts"] for row in reads.read_trades(ramp(spark, 120_000), query).collect()]
    assert times == list(range(5, 120_000))
    query = reads.TradeQuery("binance", "btcusdt", "spot", limit=110_000)
    assert reads.read_trades(ramp(spark, 120_000), query).count() == 110_000


def test_bounds_are_inclusive_and_order_follows_from(spark):
    df = ramp(spark, 100)

    def times(**bounds_):
        query = reads.TradeQuery("Binance", "BTCUSDT", "SPOT", **bounds_)
        return [row["ts"] for row in reads.read_trades(df, query).collect()]

    assert times(from_ms=10, to_ms=12) == [10, 11, 12]
    assert times(to_ms=2) == [2, 1, 0]
    assert times(limit=2) == [99, 98]
    assert times(limit=0) == []


def test_ties_have_a_fixed_order(spark):
    rows = [("Binance Spot", "x", 1, float(p), 1.0, False) for p in (3, 1, 2)]
    df = spark.createDataFrame(rows, TRADES)
    query = reads.TradeQuery("binance", "x", "spot", from_ms=0, limit=2)
    assert [r["price"] for r in reads.read_trades(df, query).collect()] == [1.0, 2.0]


def test_exchange_filter():
    assert exchange_filter("Binance", "linear") == "Binance Linear"
    assert exchange_filter("hyperliquid", "inverse") == "hyperliquid/inverse"
    with pytest.raises(ValueError, match="unknown venue: 'kraken'"):
        exchange_filter("kraken", "spot")
    with pytest.raises(ValueError, match="unknown market kind: 'futures'"):
        exchange_filter("okex", "futures")


def test_export_files_are_ordered_and_counted(spark, scratch):
    stats = exports.write_export(ramp(spark, 5_000), f"{scratch}/export", rows_per_file=1_000)
    assert stats.rows == 5_000
    assert stats.batches >= 5
    spans = (
        spark.read.parquet(f"{scratch}/export")
        .groupBy("_metadata.file_path")
        .agg({"ts": "min", "*": "count"})
        .collect()
    )
    assert len(spans) == stats.batches
    assert max(row["count(1)"] for row in spans) <= 1_000


def test_export_files_share_a_group_of_copies(spark, scratch):
    same = spark.range(8_000).selectExpr("1L AS ts", "1.0D AS price", "1.0D AS qty", "true AS is_sell")
    exports.write_export(same, f"{scratch}/export", rows_per_file=2_000)
    written = spark.read.parquet(f"{scratch}/export")
    sizes = [r["count"] for r in written.groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 8_000
    assert max(sizes) <= 2_000


def test_json_answers(spark):
    text = exports.trades_json(ramp(spark, 1)).first()["json"]
    assert text == '{"ts":0,"price":0.0,"qty":1.0,"is_sell":true}'
    query = reads.TradeQuery("binance", "btcusdt", "spot", limit=2)
    answer = exports.trades_json(reads.read_trades(ramp(spark, 5), query)).collect()
    assert [json.loads(row["json"])["ts"] for row in answer] == [4, 3]


# The inline dimensions of the fixture notes.
TEMPLATES = {
    "binance": {"spot": ["USDT", ""], "linear": ["USDT", "usdc"], "inverse": ["USD"]},
    "bybit": {"linear": ["USDT"], "spot": []},
    "hyperliquid": {"linear": ["USDC"], "spot": [""], "inverse": ["USD"]},
    "okex": {"spot": ["USDT"], "linear": ["USDT"]},
    "mexc": {"linear": ["USDT"]},
    "kraken": {"spot": ["USD"]},
}
CATALOG = [
    ("Binance Spot", "BTCUSDT", None, True),
    ("Binance Spot", "BTCDOMUSDT", None, True),
    ("Binance Spot", "ETHUSDT", None, False),
    ("Binance Linear", "BTCUSDT", None, True),
    ("Binance Linear", "ETHUSDC", None, True),
    ("Binance Inverse", "BTCUSD_PERP", None, True),
    ("Bybit Linear", "btcusdt", None, True),
    ("Bybit Linear", "ETHUSDT", None, True),
    ("Hyperliquid Linear", "BTC", None, True),
    ("Hyperliquid Linear", "ETH", None, True),
    ("Hyperliquid Spot", "@107", "BTCX/USDC", True),
    ("Hyperliquid Spot", "@108", "ETH/USDC", False),
    ("Okex Spot", "BTC-USDT", None, True),
    ("Okex Linear", "ETH-USDT-SWAP", None, True),
    ("Mexc Linear", "BTC_USDT", None, True),
]


@pytest.fixture(scope="module")
def rules(spark):
    rows = whitelist.whitelist_rows(whitelist.whitelist_from(spark, TEMPLATES))
    listed = spark.createDataFrame(
        CATALOG, "exchange string, symbol string, display_symbol string, has_info boolean"
    )
    return rows, listed


def resolved(spark, bases, rules):
    df = spark.createDataFrame([(b,) for b in bases], "base string")
    return sorted(map(tuple, catalog.resolve_pairs(df, *rules).collect()))


def test_resolve_pairs(spark, rules):
    skipped = {"ETHUSDT-Binance Spot", "@108-Hyperliquid Spot"}
    wanted = [row[:2] for row in CATALOG if f"{row[1]}-{row[0]}" not in skipped]
    assert resolved(spark, ["btc", "ETH"], rules) == sorted(wanted)
    assert resolved(spark, ["doge"], rules) == []


def test_exact_spelling_wins_over_loose_ones(spark, rules):
    rows, _ = rules
    schema = "exchange string, symbol string, display_symbol string, has_info boolean"
    both = spark.createDataFrame(
        [("Bybit Linear", "AUSDT", None, True), ("Bybit Linear", "@1", "aUSDT", True),
         ("Mexc Linear", "b_usdt", None, True), ("Mexc Linear", "@2", "B_USDT", True),
         ("Okex Spot", "C-USDT", None, False), ("Okex Spot", "c-usdt", None, True)],
        schema,
    )
    assert resolved(spark, ["a", "b", "c"], (rows, both)) == [
        ("Bybit Linear", "AUSDT"), ("Mexc Linear", "@2"), ("Okex Spot", "c-usdt"),
    ]


def test_exchange_symbols_list_all_tickers(spark, rules):
    _, listed = rules
    lists = {r[0]: r[1] for r in catalog.exchange_symbol_lists(listed).collect()}
    assert lists["Binance Spot"] == ["BTCDOMUSDT", "BTCUSDT", "ETHUSDT"]
    assert lists["Hyperliquid Spot"] == ["BTCX/USDC", "ETH/USDC"]


def test_whitelist_exchanges_and_discovery(spark, rules):
    rows, _ = rules
    wanted = {r[0]: r[1] for r in catalog.whitelist_exchanges(rows).collect()}
    assert wanted["hyperliquid"] == ["Hyperliquid Linear", "Hyperliquid Spot"]
    assert "kraken" not in wanted
    everything = {r[0]: r[1] for r in catalog.all_exchanges(spark).collect()}
    assert sum(map(len, everything.values())) == exchanges(spark).count() == 14


def test_configured_pairs_keep_order_and_spelling(spark):
    wanted = spark.createDataFrame(
        [(0, "Binance Spot", "BTCUSDT", None), (1, "Binance Linear", "ETHUSDT", None),
         (2, "Okex Linear", "DOGE-USDT-SWAP", None)],
        "pos int, exchange string, symbol string, display_symbol string",
    )
    stored = spark.createDataFrame(
        [("Binance Spot", "btcusdt", 1, 9), ("Binance Linear", "ethusdt", 2, 3),
         ("Mexc Spot", "other", 1, 1)],
        "exchange string, symbol string, earliest bigint, latest bigint",
    )
    pairs = bounds.configured_pairs(wanted, stored)
    assert [tuple(r) for r in pairs.collect()] == [
        (0, "Binance Spot", "btcusdt", 1, 9), (1, "Binance Linear", "ethusdt", 2, 3),
        (2, "Okex Linear", "DOGE-USDT-SWAP", None, None),
    ]
    counts = bounds.tracked_counts(pairs).first()
    assert tuple(counts) == (3, 3)
    texts = [r["json"] for r in exports.pairs_json(pairs).orderBy("pos").collect()]
    assert texts[0] == '{"ticker":"BinanceSpot:btcusdt","earliest":1,"latest":9}'
    assert texts[2].endswith('"earliest":null,"latest":null}')


def test_upsert_last_write_wins(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", None, 1)], "k string, v int, s int")
    found = upserts.upsert(old, new, ["k"], "s").collect()
    assert sorted(tuple(r) for r in found) == [("a", 1), ("b", 4), ("c", None)]
