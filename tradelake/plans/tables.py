"""Inputs of the registered queries, derived from the given tables.

Every function takes the DataFrame of one given table (batch or stream) and gives
one of the engine's input shapes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.sources.exchanges import EXCHANGES
from tradelake.sources.table import TradeTable

FIRST_MS = 1_704_067_200_000
#: Events arrive in four batches by time, some of them one batch late.
BATCHES = 4
BATCH_MS = 8 * 86_400_000
LATE_EVERY = 23


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_arrival(rows: DataFrame) -> list[DataFrame]:
    """Rows with ``seq`` and ``at_ms`` as the batches in which they arrive."""
    batch = f"""least({BATCHES - 1}L, greatest(0L, (at_ms - {FIRST_MS}L) div {BATCH_MS}L)
        + if(seq % {LATE_EVERY} = 0, 1L, 0L))"""
    return [rows.filter(f"{batch} = {n}") for n in range(BATCHES)]


def _pick(key: str, *names: str) -> str:
    listed = ", ".join(f"'{name}'" for name in names)
    return f"element_at(array({listed}), int(pmod({key}, {len(names)})) + 1)"


def traded_exchange(key: str) -> str:
    return _pick(
        key,
        "Binance Spot",
        "Binance Linear",
        "Bybit Linear",
        "Okex Linear",
        "Bybit Spot",
        "Hyperliquid Linear",
    )


def any_exchange(key: str) -> str:
    return _pick(key, *[row[0] for row in EXCHANGES])


def _at_ms(column: str) -> str:
    return f"unix_millis(cast({column} AS timestamp))"


def raw_trades(lineitem: DataFrame) -> DataFrame:
    """One trade per order line; half of them carry a display symbol."""
    named = lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS seq",
        f"{traded_exchange('l_suppkey')} AS exchange",
        _pick("l_partkey", "BTCUSDT", "ETHUSDT", "SOLUSDT", "XRPUSDT", "BTCUSDC") + " AS name",
        "l_partkey",
        f"""{_at_ms('l_shipdate')} + pmod(l_orderkey * 7919 + l_partkey * 104729
            + l_suppkey * 31 + l_linenumber, 86400000) AS ts""",
        "l_extendedprice / l_quantity AS price",
        "l_quantity AS qty",
        "l_returnflag = 'R' AS is_sell",
    )
    return named.selectExpr(
        "seq",
        "exchange",
        "CASE WHEN l_partkey % 2 = 0 THEN '@' || l_partkey ELSE name END AS ticker",
        "CASE WHEN l_partkey % 2 = 0 THEN name END AS display_symbol",
        "ts",
        "price",
        "qty",
        "is_sell",
    )


def market_events(lineitem: DataFrame) -> DataFrame:
    """Events with one to three equal trades each, and events not to be stored."""
    return raw_trades(lineitem).selectExpr(
        "seq",
        "ts AS at_ms",
        "exchange",
        _pick("seq", "depth", "kline", "connected", *["trades"] * 14) + " AS kind",
        """array_repeat(named_struct('ticker', ticker, 'display_symbol', display_symbol,
            'ts', ts, 'price', price, 'qty', qty, 'is_sell', is_sell),
            int(pmod(seq, 3)) + 1) AS trades""",
    )


def ticker_updates(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        f"{traded_exchange('l_suppkey')} AS exchange",
        "CASE WHEN l_linenumber % 2 = 1 THEN 'T' || pmod(l_partkey, 500) ELSE '@1' END AS ticker",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'T' || pmod(l_partkey, 500) END AS display_symbol",
        "-l_linenumber AS min_ticksize",
        "-int(pmod(l_suppkey, 5)) AS min_qty",
        "CASE WHEN pmod(l_partkey, 3) > 0 THEN int(pmod(l_partkey, 4)) END AS contract_size",
        """struct(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)
            AS place""",
        "pmod(l_orderkey, 2) = 1 AS is_new",
    )


def _events(events: DataFrame, *columns: str) -> DataFrame:
    return events.selectExpr("event_id AS seq", f"{_at_ms('ts')} AS at_ms", *columns)


def feed_events(events: DataFrame) -> DataFrame:
    return _events(
        events,
        "pmod(user_id, 10) AS node_id",
        f"{traded_exchange('user_id')} AS exchange",
        """CASE WHEN event_id % 97 = 0 THEN 'stopped' WHEN event_type = 'click'
            THEN 'connected' WHEN event_type = 'error' THEN 'disconnected'
            WHEN event_type = 'signup' THEN 'restarting' ELSE 'data' END AS kind""",
        "event_type || ':' || props AS reason",
    )


def commits(events: DataFrame) -> DataFrame:
    bought = events.filter("event_type = 'purchase'")
    return bought.selectExpr(
        f"{traded_exchange('user_id')} AS exchange", f"{_at_ms('ts')} AS flushed_at"
    )


def flush_events(events: DataFrame) -> DataFrame:
    return _events(
        events,
        "pmod(user_id, 10) AS node_id",
        """CASE WHEN event_id % 1999 = 7 THEN 'dropped' WHEN event_type = 'error'
            THEN 'failed' WHEN event_type = 'signup' THEN 'retry_ok'
            ELSE 'ok' END AS kind""",
        "event_id % 50 AS n",
        "event_type || ':' || props AS error",
    )


#: Nodes of the ingest that fails: how often each is refused its first batch, and after
#: how many failures it gives a batch up.
REFUSALS: dict[int, tuple[int, int | None]] = {1: (0, None), 2: (2, None), 3: (9, 2)}
NODE_OF_EXCHANGE = "CASE WHEN exchange LIKE 'Binance%' THEN 1 WHEN exchange LIKE 'Bybit%' THEN 2 ELSE 3 END"


@dataclass(frozen=True)
class UnreliableTable(TradeTable):
    """A table whose store turns batches away, each as often as ``refusals`` says."""

    refusals: dict[int, int] = field(default_factory=dict)

    def append(self, trades: DataFrame, batch_id: int, flushed_at: int, source: str = "batch") -> int:
        if self.refusals.get(batch_id, 0) > 0:
            self.refusals[batch_id] -= 1
            raise OSError(f"no space for batch {batch_id}")
        return super().append(trades, batch_id, flushed_at, source)


def drop_events(events: DataFrame) -> DataFrame:
    return _events(
        events,
        "pmod(user_id, 10) AS node_id",
        """CASE pmod(event_id, 3) WHEN 0 THEN 'event_channel'
            WHEN 1 THEN 'persist_channel' ELSE 'data_buffer' END AS stage""",
        f"{traded_exchange('user_id')} AS exchange",
        "CASE WHEN event_type IN ('click', 'error') THEN 'drop' ELSE 'recovered' END AS kind",
        "event_id % 50 AS n",
    )


def access_events(events: DataFrame) -> DataFrame:
    return _events(
        events,
        "pmod(user_id, 10) AS node_id",
        "user_id AS client",
        """CASE event_type WHEN 'click' THEN 'auth_failure'
            WHEN 'error' THEN 'admission_blocked' WHEN 'purchase' THEN 'rate_limited'
            WHEN 'signup' THEN 'connection_rejected' ELSE 'accept_timeout' END AS kind""",
    )


def read_requests(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        _pick("user_id", "binance", "Bybit", "mexc", "HYPERLIQUID", "okex", "kraken", "binance")
        + " AS venue",
        _pick("event_id", "spot", "linear", "inverse", "Spot", "futures") + " AS market",
    )


def metadata_log(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        """CASE WHEN event_type = 'purchase' THEN 'last_cleanup'
            ELSE 'user_' || user_id END AS key""",
        f"string({_at_ms('ts')}) AS value",
        "event_id AS seq",
        "pmod(event_id, 2) = 1 AS is_new",
    )


def catalog(part: DataFrame) -> DataFrame:
    """A symbol catalogue: mixed spellings, display names, some without information."""
    from tradelake.operators.catalog import candidate_tickers

    pairs = part.selectExpr(
        "p_partkey AS k",
        f"{any_exchange('p_partkey')} AS exchange",
        "'A' || (p_partkey div 42) AS base",
        _pick("p_partkey div 14", "USDT", "USDC", "USD") + " AS quote",
    )
    return candidate_tickers(pairs).selectExpr(
        "k",
        "exchange",
        """CASE WHEN exchange = 'Hyperliquid Spot' OR k % 13 = 0 THEN '@' || k
            WHEN k % 11 = 0 THEN lower(ticker) ELSE ticker END AS symbol""",
        """CASE WHEN exchange = 'Hyperliquid Spot' THEN base || '/' || quote
            WHEN k % 13 = 0 THEN ticker END AS display_symbol""",
        "k % 9 <> 4 AS has_info",
    )


def bases(customer: DataFrame) -> DataFrame:
    """Assets in mixed case, each wanted by several customers."""
    return customer.selectExpr(
        _pick("c_custkey", "a", "A") + " || (c_custkey div 10) AS base"
    )


def whitelist_configs(customer: DataFrame) -> DataFrame:
    """One configuration per customer."""
    return customer.selectExpr(
        "c_custkey AS config_id",
        """map(element_at(array('binance', 'bybit', 'mexc', 'hyperliquid', 'okex', 'kraken',
                'Binance'), int(c_custkey % 7) + 1),
            CASE WHEN c_custkey % 3 < 2 THEN map(
                'spot', CASE c_custkey % 5 WHEN 0 THEN array('USDT')
                    WHEN 1 THEN array('USDT', 'usdc') WHEN 2 THEN array()
                    WHEN 3 THEN array('USD') ELSE array('USDC', 'USDT', 'USD') END,
                'linear', CASE c_custkey % 4 WHEN 0 THEN array('usdt')
                    WHEN 1 THEN array('USDC') WHEN 2 THEN array('USD', 'USDT')
                    ELSE array() END)
            ELSE map(
                'inverse', CASE WHEN c_custkey % 2 = 0 THEN array('USD') ELSE array() END,
                'spot', CASE WHEN c_custkey % 7 IN (0, 3) THEN array('')
                    ELSE array('USDT') END) END) AS templates""",
    )


def configured(part: DataFrame) -> DataFrame:
    """Configured pairs: traded ones, one never traded, one known by display name."""
    return part.selectExpr(
        "p_partkey AS pos",
        f"{traded_exchange('p_partkey')} AS exchange",
        """CASE pmod(p_partkey, 7) WHEN 0 THEN 'BTCUSDT' WHEN 1 THEN 'ETHUSDT'
            WHEN 2 THEN 'solusdt' WHEN 3 THEN 'XRPUSDT' WHEN 4 THEN 'BTCUSDC'
            WHEN 5 THEN 'DOGEUSDT' ELSE '@' || p_partkey END AS symbol""",
        "CASE WHEN pmod(p_partkey, 7) = 6 THEN 'BTCUSDT' END AS display_symbol",
    )


def messages(lineitem: DataFrame) -> DataFrame:
    """Events as JSON text; every 29th is cut short, every 31st no event at all."""
    return market_events(lineitem).selectExpr(
        "seq",
        """CASE WHEN seq % 29 = 0 THEN left(to_json(struct(*)), 20)
            WHEN seq % 31 = 0 THEN '{"seq":' || seq || '}' ELSE to_json(struct(*)) END AS value""",
    )


def table_sizes(orders: DataFrame) -> DataFrame:
    """Sizes, row counts and caps of many tables, small, large and empty."""
    return orders.selectExpr(
        "o_orderkey",
        "floor(o_totalprice) * 4000 AS size_bytes",
        "pmod(o_custkey * 7919, 60000) * (1 + pmod(o_orderkey, 1000)) AS row_count",
        """CASE WHEN o_orderkey % 50 = 0 THEN 60 * 1073741824L
            ELSE (1 + o_orderkey % 100) * 7340032L END AS cap_bytes""",
    )
