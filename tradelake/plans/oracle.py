"""DuckDB SQL of the same meaning as each registered query.

Written from the rules and not from the Spark jobs: state machines walk their log
with windows or recursion, and pair resolution enumerates assets x templates.
"""

from __future__ import annotations

from tradelake.plans.registry import FROM_MS, HOURS, NOW_MS, SIX_HOURS, TO_MS, TWO_DAYS
from tradelake.plans.tables import BATCH_MS, BATCHES, FIRST_MS, LATE_EVERY
from tradelake.sources.exchanges import EXCHANGES


def _traded(key: str) -> str:
    return f"""(CASE {key} % 6 WHEN 0 THEN 'Binance Spot' WHEN 1 THEN 'Binance Linear'
        WHEN 2 THEN 'Bybit Linear' WHEN 3 THEN 'Okex Linear' WHEN 4 THEN 'Bybit Spot'
        ELSE 'Hyperliquid Linear' END)"""


def _any(key: str) -> str:
    names = ", ".join(f"'{row[0]}'" for row in EXCHANGES)
    return f"([{names}])[{key} % {len(EXCHANGES)} + 1]"


def _text(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


PARTS = {
    "exchanges": """exchanges(exchange, venue, market, joiner, suffix) AS (VALUES
        {})""".format(", ".join(f"({', '.join(map(_text, row))})" for row in EXCHANGES)),
    "raw": f"""raw AS (SELECT seq, exchange, ts, price, qty, is_sell,
        CASE WHEN l_partkey % 2 = 0 THEN '@' || l_partkey ELSE name END AS ticker,
        CASE WHEN l_partkey % 2 = 0 THEN name END AS display_symbol
        FROM (SELECT l_orderkey * 10 + l_linenumber AS seq, l_partkey,
            {_traded('l_suppkey')} AS exchange,
            CASE l_partkey % 5 WHEN 0 THEN 'BTCUSDT' WHEN 1 THEN 'ETHUSDT'
                WHEN 2 THEN 'SOLUSDT' WHEN 3 THEN 'XRPUSDT' ELSE 'BTCUSDC' END AS name,
            epoch_us(l_shipdate) // 1000 + (l_orderkey * 7919 + l_partkey * 104729
                + l_suppkey * 31 + l_linenumber) % 86400000 AS ts,
            l_extendedprice / l_quantity AS price, l_quantity AS qty,
            l_returnflag = 'R' AS is_sell FROM lineitem))""",
    "trades": """trades AS (SELECT exchange, lower(coalesce(display_symbol, ticker))
        AS symbol, ts, price, qty, is_sell FROM raw)""",
    "routed": """routed AS (SELECT exchange,
        lower(coalesce(display_symbol, ticker)) AS symbol, ts, price, qty, is_sell
        FROM (SELECT *, unnest(generate_series(0, seq % 3)) FROM raw
            WHERE seq % 17 NOT IN (0, 1, 2)))""",
    "whitelist": """whitelist AS (SELECT config_id, venue, market, unnest(quotes) AS quote
        FROM (SELECT *, (['binance', 'bybit', 'mexc', 'hyperliquid', 'okex', 'kraken',
            'Binance'])[config_id % 7 + 1] AS venue FROM (
        SELECT c_custkey AS config_id, 'spot' AS market, CASE c_custkey % 5
            WHEN 0 THEN ['USDT'] WHEN 1 THEN ['USDT', 'usdc'] WHEN 2 THEN []
            WHEN 3 THEN ['USD'] ELSE ['USDC', 'USDT', 'USD'] END AS quotes
            FROM customer WHERE c_custkey % 3 < 2
        UNION ALL SELECT c_custkey, 'linear', CASE c_custkey % 4 WHEN 0 THEN ['usdt']
            WHEN 1 THEN ['USDC'] WHEN 2 THEN ['USD', 'USDT'] ELSE [] END
            FROM customer WHERE c_custkey % 3 < 2
        UNION ALL SELECT c_custkey, 'inverse',
            CASE WHEN c_custkey % 2 = 0 THEN ['USD'] ELSE [] END
            FROM customer WHERE c_custkey % 3 = 2
        UNION ALL SELECT c_custkey, 'spot',
            CASE WHEN c_custkey % 7 IN (0, 3) THEN [''] ELSE ['USDT'] END
            FROM customer WHERE c_custkey % 3 = 2)))""",
    "catalog": f"""catalog AS (SELECT k, exchange,
        CASE WHEN exchange = 'Hyperliquid Spot' OR k % 13 = 0 THEN '@' || k
            WHEN k % 11 = 0 THEN lower(ticker) ELSE ticker END AS symbol,
        CASE WHEN exchange = 'Hyperliquid Spot' THEN base || '/' || quote
            WHEN k % 13 = 0 THEN ticker END AS display_symbol,
        k % 9 <> 4 AS has_info
        FROM (SELECT *, CASE WHEN joiner IS NULL THEN base
                ELSE base || joiner || quote || suffix END AS ticker
            FROM (SELECT p_partkey AS k, {_any('p_partkey')} AS exchange,
                'A' || (p_partkey // 42) AS base,
                (['USDT', 'USDC', 'USD'])[(p_partkey // 14) % 3 + 1] AS quote FROM part)
            JOIN exchanges USING (exchange)))""",
    "wanted": """assets AS (SELECT DISTINCT upper(CASE WHEN c_custkey % 2 = 0 THEN 'a'
            ELSE 'A' END || (c_custkey // 10)) AS base FROM customer),
        templates AS (SELECT DISTINCT exchange, joiner, suffix, upper(quote) AS quote
            FROM whitelist JOIN exchanges ON exchanges.venue = lower(whitelist.venue)
            AND exchanges.market = lower(whitelist.market)),
        wanted AS (SELECT * FROM assets CROSS JOIN templates)""",
    "candidates": """candidates AS (SELECT DISTINCT exchange, CASE WHEN joiner IS NULL
        THEN base ELSE base || joiner || quote || suffix END AS ticker
        FROM wanted WHERE quote <> '')""",
    "resolved": """exact AS (SELECT c.exchange, ticker, symbol FROM candidates c
            JOIN catalog k ON k.exchange = c.exchange AND k.symbol = c.ticker AND has_info),
        loose AS (SELECT c.exchange, ticker, min(symbol) AS symbol FROM candidates c
            JOIN (SELECT exchange, symbol, symbol AS name FROM catalog WHERE has_info
                UNION ALL SELECT exchange, symbol, display_symbol FROM catalog
                WHERE has_info AND display_symbol IS NOT NULL) k
            ON k.exchange = c.exchange AND upper(k.name) = c.ticker
            WHERE NOT EXISTS (SELECT 1 FROM exact e
                WHERE e.exchange = c.exchange AND e.ticker = c.ticker)
            GROUP BY ALL),
        resolved AS (SELECT exchange, symbol FROM exact UNION
            SELECT exchange, symbol FROM loose UNION
            SELECT k.exchange, k.symbol FROM wanted w JOIN catalog k
            ON k.exchange = w.exchange AND (starts_with(upper(k.symbol), w.base)
                OR starts_with(upper(k.display_symbol), w.base))
            WHERE w.quote = '' AND has_info)""",
    "bounds": """bounds AS (SELECT exchange, symbol, min(ts) AS earliest,
        max(ts) AS latest FROM trades GROUP BY ALL)""",
    "pairs": f"""configured AS (SELECT p_partkey AS pos, {_traded('p_partkey')} AS exchange,
        CASE p_partkey % 7 WHEN 0 THEN 'BTCUSDT' WHEN 1 THEN 'ETHUSDT' WHEN 2 THEN 'solusdt'
            WHEN 3 THEN 'XRPUSDT' WHEN 4 THEN 'BTCUSDC' WHEN 5 THEN 'DOGEUSDT'
            ELSE '@' || p_partkey END AS symbol,
        CASE WHEN p_partkey % 7 = 6 THEN 'BTCUSDT' END AS display_symbol FROM part),
        pairs AS (SELECT pos, c.exchange, coalesce(b.symbol, c.symbol) AS symbol,
            earliest, latest FROM configured c LEFT JOIN bounds b ON b.exchange = c.exchange
            AND b.symbol = lower(coalesce(c.display_symbol, c.symbol)))""",
    "metadata": """log AS (SELECT CASE WHEN event_type = 'purchase' THEN 'last_cleanup'
            ELSE 'user_' || user_id END AS key,
            CAST(epoch_us(ts) // 1000 AS VARCHAR) AS value, event_id FROM events),
        metadata AS (SELECT key, value FROM log QUALIFY row_number() OVER
            (PARTITION BY key ORDER BY event_id % 2 DESC, event_id DESC) = 1)""",
    "feed_events": f"""feed_events AS (SELECT event_id AS seq, user_id % 10 AS node_id,
        {_traded('user_id')} AS exchange, epoch_us(ts) // 1000 AS at_ms,
        CASE WHEN event_id % 97 = 0 THEN 'stopped' WHEN event_type = 'click' THEN 'connected'
            WHEN event_type = 'error' THEN 'disconnected' WHEN event_type = 'signup'
            THEN 'restarting' ELSE 'data' END AS kind,
        event_type || ':' || props AS reason FROM events)""",
    "flush_events": """flush_events AS (SELECT event_id AS seq, user_id % 10 AS node_id,
        epoch_us(ts) // 1000 AS at_ms, CASE WHEN event_id % 1999 = 7 THEN 'dropped'
            WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'retry_ok'
            ELSE 'ok' END AS kind,
        event_id % 50 AS n, event_type || ':' || props AS error FROM events)""",
    # Trades of two batches of three nodes; see tables.REFUSALS.
    "flushed": f"""flushed AS (SELECT CASE WHEN exchange LIKE 'Binance%' THEN 1
            WHEN exchange LIKE 'Bybit%' THEN 2 ELSE 3 END AS node_id, seq % 2 AS batch,
            CAST(sum(CASE WHEN seq % 17 > 2 THEN seq % 3 + 1 ELSE 0 END) AS BIGINT) AS n
        FROM (SELECT l_orderkey * 10 + l_linenumber AS seq, {_traded('l_suppkey')} AS exchange
            FROM lineitem) GROUP BY ALL)""",
    "outcomes": """outcomes AS (SELECT batch * 65536 + attempt AS seq, CAST(node_id AS BIGINT) AS node_id,
        batch * 65536 + attempt AS at_ms, outcome, n,
        CASE WHEN outcome LIKE '%failure' THEN 'no space for batch 0' END AS error
        FROM flushed JOIN (VALUES (1, 0, 0, 'success'), (1, 1, 0, 'success'), (2, 0, 0, 'failure'),
            (2, 0, 1, 'failure'), (2, 0, 2, 'retry_success'), (2, 1, 0, 'success'),
            (3, 0, 0, 'failure'), (3, 0, 1, 'final_failure'), (3, 1, 0, 'success'))
            AS told(node_id, batch, attempt, outcome) USING (node_id, batch))""",
    "outcome_events": """outcome_events AS (
        SELECT seq * 2 AS seq, node_id, at_ms, CASE outcome WHEN 'success' THEN 'ok'
            WHEN 'retry_success' THEN 'retry_ok' ELSE 'failed' END AS kind,
            CASE WHEN outcome IN ('failure', 'final_failure') THEN n ELSE 0 END AS n, error
        FROM outcomes
        UNION ALL SELECT seq * 2 + 1, node_id, at_ms, 'dropped', n, error FROM outcomes
        WHERE outcome = 'final_failure')""",
    "drop_events": f"""drop_events AS (SELECT event_id AS seq, user_id % 10 AS node_id,
        epoch_us(ts) // 1000 AS at_ms, CASE event_id % 3 WHEN 0 THEN 'event_channel'
            WHEN 1 THEN 'persist_channel' ELSE 'data_buffer' END AS stage,
        {_traded('user_id')} AS exchange,
        CASE WHEN event_type IN ('click', 'error') THEN 'drop' ELSE 'recovered' END AS kind,
        event_id % 50 AS n FROM events)""",
    "access_events": """access_events AS (SELECT event_id AS seq, user_id % 10 AS node_id,
        user_id AS client, epoch_us(ts) // 1000 AS at_ms, CASE event_type
            WHEN 'click' THEN 'auth_failure' WHEN 'error' THEN 'admission_blocked'
            WHEN 'purchase' THEN 'rate_limited' WHEN 'signup' THEN 'connection_rejected'
            ELSE 'accept_timeout' END AS kind FROM events)""",
    "saturation": """latches AS (SELECT node_id, stage,
            CASE WHEN stage = 'event_channel' THEN exchange END AS latch,
            arg_max(kind, seq) = 'drop' AS closed
            FROM (SELECT * REPLACE (row_number() OVER (ORDER BY at_ms, seq) AS seq)
                FROM drop_events) GROUP BY ALL),
        saturation AS (SELECT node_id,
            coalesce(bool_or(closed) FILTER (WHERE stage = 'event_channel'), false)
                AS event_channel_saturated,
            coalesce(bool_or(closed) FILTER (WHERE stage = 'persist_channel'), false)
                AS persist_channel_saturated,
            coalesce(bool_or(closed) FILTER (WHERE stage = 'data_buffer'), false)
                AS data_buffer_saturated FROM latches GROUP BY ALL)""",
}


#: The batch in which an event arrives.
_BATCH = f"""least({BATCHES - 1}, greatest(0, (at_ms - {FIRST_MS}) // {BATCH_MS})
    + CASE WHEN seq % {LATE_EVERY} = 0 THEN 1 ELSE 0 END)"""


def _arrived(source: str, key: str) -> str:
    """Events in order of arrival; ``came`` never falls back behind an earlier batch."""
    return f"""batched AS (SELECT *, {_BATCH} AS batch FROM {source}),
        arrived AS (SELECT *, greatest(at_ms, coalesce(max(at_ms) OVER (PARTITION BY {key}
            ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), at_ms)) AS came
            FROM batched)"""


def _feeds(name: str, keys: str, order: str = "at_ms, seq") -> str:
    """Feed health by walking each feed's log with windows."""
    return f"""numbered AS (SELECT *, row_number() OVER (ORDER BY {order}) AS place,
            CASE kind WHEN 'connected' THEN 'connected' WHEN 'stopped' THEN 'stopped'
                WHEN 'data' THEN NULL ELSE 'reconnecting' END AS after FROM feed_events),
        walked AS (SELECT *, coalesce(lag(after) OVER (PARTITION BY {keys} ORDER BY place),
            'starting') AS before FROM numbered WHERE kind <> 'data'
            UNION ALL SELECT *, NULL FROM numbered WHERE kind = 'data'),
        {name} AS (SELECT {keys},
            coalesce(arg_max(after, place) FILTER (WHERE kind <> 'data'), 'starting')
                AS state,
            max(at_ms) FILTER (WHERE kind = 'connected') AS connected_at,
            max(at_ms) FILTER (WHERE kind = 'data') AS last_data_at,
            (arg_max({{'e': CASE WHEN kind <> 'connected' THEN reason END}}, place)
                FILTER (WHERE kind <> 'data')).e AS last_error,
            count(*) FILTER (WHERE kind = 'disconnected' AND before = 'connected')
                AS disconnect_count,
            count(*) FILTER (WHERE kind = 'disconnected' AND before <> 'connected')
                AS failed_connect_attempts,
            count(*) FILTER (WHERE kind = 'connected' AND before = 'reconnecting')
                AS reconnect_count,
            count(*) FILTER (WHERE kind = 'restarting') AS stream_restart_count
            FROM walked GROUP BY {keys})"""


def _flushes(source: str, order: str = "at_ms, seq") -> str:
    """Write health by walking each node's log with windows."""
    return f"""ranked AS (SELECT *, row_number() OVER (ORDER BY {order}) AS place
            FROM {source}),
        walk AS (SELECT *,
            coalesce(last_value(CASE kind WHEN 'failed' THEN n WHEN 'ok' THEN NULL ELSE 0 END
                IGNORE NULLS) OVER before, 0) AS waiting,
            coalesce(sum(CASE kind WHEN 'dropped' THEN n ELSE 0 END) OVER before, 0) AS lost
            FROM ranked WINDOW before AS (PARTITION BY node_id ORDER BY place
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        told AS (SELECT *,
            CASE WHEN kind IN ('failed', 'dropped') THEN false
                WHEN kind = 'retry_ok' AND lost = 0 THEN true
                WHEN kind = 'ok' AND waiting = 0 AND lost = 0 THEN true END AS healthy,
            kind IN ('failed', 'retry_ok') OR (kind = 'ok' AND waiting = 0 AND lost = 0)
                AS tells_error FROM walk),
        flush_health AS (SELECT node_id,
            coalesce(arg_max(healthy, place) FILTER (WHERE healthy IS NOT NULL), true)
                AS persistence_healthy,
            max(at_ms) FILTER (WHERE kind IN ('ok', 'retry_ok')) AS last_flush_at,
            (arg_max({{'e': CASE WHEN kind = 'failed' THEN error END}}, place)
                FILTER (WHERE tells_error)).e AS last_flush_error,
            count(*) FILTER (WHERE kind = 'failed') AS flush_failure_count,
            CAST(coalesce(arg_max(CASE kind WHEN 'failed' THEN n ELSE 0 END, place)
                FILTER (WHERE kind <> 'ok'), 0) AS BIGINT) AS flush_retry_pending_trades,
            CAST(coalesce(sum(n) FILTER (WHERE kind = 'dropped'), 0) AS BIGINT)
                AS flush_dropped_trades FROM told GROUP BY node_id)"""


_COUNTERS = """count(*) FILTER (WHERE kind = 'auth_failure') AS auth_failures,
    count(*) FILTER (WHERE kind = 'admission_blocked') AS admission_blocked,
    count(*) FILTER (WHERE kind = 'rate_limited') AS rate_limited,
    count(*) FILTER (WHERE kind = 'connection_rejected') AS connection_rejected,
    count(*) FILTER (WHERE kind = 'accept_timeout') AS accept_timeouts"""

_FEED_ANSWER = f"""commits AS (SELECT {_traded('user_id')} AS exchange,
        max(epoch_us(ts) // 1000) AS last_persist_at FROM events
        WHERE event_type = 'purchase' GROUP BY ALL)
    SELECT exchange, coalesce(state, 'starting') AS state, connected_at, last_data_at,
        last_error, coalesce(disconnect_count, 0) AS disconnect_count,
        coalesce(failed_connect_attempts, 0) AS failed_connect_attempts,
        coalesce(reconnect_count, 0) AS reconnect_count,
        coalesce(stream_restart_count, 0) AS stream_restart_count, last_persist_at
    FROM exchanges LEFT JOIN feeds USING (exchange) LEFT JOIN commits USING (exchange)"""

_STATUS = """states AS (SELECT node_id, bool_or(state IN ('reconnecting', 'stopped')) AS down,
        bool_or(state = 'starting') AS starting FROM feeds GROUP BY ALL)
    SELECT node_id, CASE WHEN node_id = 3 OR NOT persistence_healthy
        OR flush_retry_pending_trades > 0 OR flush_dropped_trades > 0
        OR event_channel_saturated OR persist_channel_saturated
        OR data_buffer_saturated OR down THEN 'degraded'
        WHEN starting THEN 'starting' ELSE 'healthy' END AS status
    FROM flush_health FULL JOIN saturation USING (node_id)
        FULL JOIN states USING (node_id)"""

_SIZE_RULE = "(n - n * 3 // 5)"
_CUTOFF = NOW_MS - HOURS * 3_600_000
_OLDEST_FIRST = "ORDER BY ts, exchange, symbol, price, qty, is_sell"



def _sample(source: str, at: str, order: str) -> str:
    return f"""starts AS (SELECT DISTINCT node_id, CAST({FIRST_MS} AS BIGINT) AS began
            FROM {source}
        UNION ALL SELECT node_id, began FROM (SELECT s.node_id, min(e.{at}) AS began
            FROM starts s JOIN {source} e ON e.node_id = s.node_id
                AND e.{at} >= s.began + {SIX_HOURS} GROUP BY s.node_id)),
    windows AS (SELECT e.*, s.began AS window_start_ms FROM {source} e
        ASOF JOIN starts s ON e.node_id = s.node_id AND e.{at} >= s.began)
    SELECT seq, node_id, client, at_ms, kind, window_start_ms, nth FROM (SELECT *,
        row_number() OVER (PARTITION BY node_id, window_start_ms, kind ORDER BY {order}) AS nth
        FROM windows) WHERE nth <= 3"""


def _limiter(source: str, at: str, order: str) -> str:
    return f"""numbered AS (SELECT seq, client, at_ms, {at} AS t, row_number() OVER
            (PARTITION BY client ORDER BY {order}) AS nth FROM {source}),
    walk AS (SELECT seq, client, at_ms, t, nth, CAST(2 AS DOUBLE) AS tokens, true AS allowed
            FROM numbered WHERE nth = 1
        UNION ALL SELECT seq, client, at_ms, t, nth,
            CASE WHEN filled >= 1 THEN filled - 1 ELSE filled END, filled >= 1
            FROM (SELECT n.*, least(CAST(3 AS DOUBLE), w.tokens + CAST(n.t - w.t
                AS DOUBLE) * (CAST(3 AS DOUBLE) / {TWO_DAYS})) AS filled FROM walk w
                JOIN numbered n ON n.client = w.client AND n.nth = w.nth + 1))"""


def _with(parts: str, body: str, recursive: bool = False) -> str:
    texts = ", ".join(PARTS.get(name, name) for name in parts.split())
    return f"WITH {'RECURSIVE ' if recursive else ''}{texts} {body}"


def _trades(body: str) -> str:
    return _with("raw trades", body)


def _read(
    exchange: str, symbol: str, bounds: str, order: str, limit: int | None = None, what: str = "*"
):
    by = ", ".join(f"{name} {order}" for name in ("ts", "price", "qty", "is_sell"))
    return _trades(
        f"""SELECT {what} FROM trades WHERE exchange = '{exchange}' AND symbol = '{symbol}'
        {bounds} ORDER BY {by} {'' if limit is None else f'LIMIT {limit}'}"""
    )


def _access(body: str) -> str:
    return _with("access_events", body)


def oracle_sql() -> dict[str, str]:
    resolve = "exchanges whitelist catalog wanted candidates resolved"
    feeds = f"{PARTS['exchanges']}, {PARTS['feed_events']}, {_feeds('feeds', 'exchange')}"
    feed_answer = f"WITH {feeds}, {_FEED_ANSWER}"
    summary = _access(
        f"""SELECT node_id, CAST({FIRST_MS} + (at_ms - {FIRST_MS}) // {SIX_HOURS}
        * {SIX_HOURS} AS BIGINT) AS interval_start_ms, {_COUNTERS}
        FROM access_events GROUP BY ALL"""
    )
    recursive = f"WITH RECURSIVE {PARTS['access_events']}, "
    in_time, in_turn = "at_ms, seq", "batch, came, seq"
    sample = recursive + _sample("access_events", "at_ms", in_time)
    limiter = recursive + _limiter("access_events", "at_ms", in_time)
    late_feeds = f"""WITH {PARTS['exchanges']}, {PARTS['feed_events']},
        {_feeds('feeds', 'exchange', f'{_BATCH}, at_ms, seq')}, {_FEED_ANSWER}"""
    flags = "SELECT seq, client, at_ms, allowed FROM walk"
    health = _flushes("flush_events")
    late_health = _flushes("flush_events", f"{_BATCH}, at_ms, seq")
    between = f"AND ts >= {FROM_MS} AND ts <= {TO_MS}"
    shown = "upper(coalesce(display_symbol, symbol))"
    answer = "ts, price, qty, is_sell"
    return {
        "normalize_trades": _trades("SELECT * FROM trades"),
        "route_trades": _with("raw routed", "SELECT * FROM routed"),
        "ingest_trades": _with("raw routed", "SELECT * FROM routed"),
        "ingest_merged": _with("raw routed", "SELECT * FROM routed"),
        "ingest_dead_letters": _with(
            "raw",
            """SELECT unparsed, CAST(sum(stored) AS BIGINT) AS trades, count(*) AS n FROM (
            SELECT CASE WHEN seq % 29 = 0 THEN left('{"seq":' || seq || ',"at_ms":' || ts || ',', 20)
                ELSE '{"seq":' || seq || '}' END AS unparsed, 0 AS stored FROM raw
                WHERE seq % 29 = 0 OR seq % 31 = 0
            UNION ALL SELECT NULL, 1 FROM (SELECT unnest(generate_series(0, seq % 3)) FROM raw
                WHERE seq % 17 NOT IN (0, 1, 2) AND seq % 29 <> 0 AND seq % 31 <> 0))
            GROUP BY ALL""",
        ),
        "ingest_rejects": _trades(
            """SELECT exchange, symbol, ts, CAST(NULL AS DOUBLE) AS price, qty, is_sell,
            'batch' AS source, CAST(0 AS BIGINT) AS batch_id FROM trades WHERE qty = 7"""
        ),
        "batch_exchanges": _trades(
            "SELECT DISTINCT ts // 604800000 AS batch_id, exchange FROM trades"
        ),
        "trades_range_asc": _read("Binance Spot", "btcusdt", between, "ASC"),
        "trades_latest_desc": _read("Binance Spot", "btcusdt", "", "DESC", 25_000),
        "trades_to_only": _read(
            "Bybit Linear", "ethusdt", f"AND ts <= {TO_MS}", "DESC", 100
        ),
        "trades_unsupported_pair": _read("hyperliquid/inverse", "btcusdt", "", "DESC"),
        "trades_export": _read(
            "Okex Linear", "xrpusdt", f"AND ts >= {FROM_MS}", "ASC", None, answer
        ),
        "trades_export_files": _trades(f"SELECT {answer} FROM trades"),
        "trades_arrow_streams": _read("Binance Spot", "btcusdt", "", "DESC", None, answer),
        "trades_export_stats": """SELECT count(*) AS rows_written, count(*) AS rows_read,
            count(*) AS rows_streamed, count(*) > 0 AS any_batches FROM lineitem""",
        "trades_stored_latest": _read("Bybit Spot", "solusdt", "", "DESC", 50),
        "trades_json": _trades("SELECT * FROM trades"),
        "venue_market_exchange": _with(
            "exchanges",
            """SELECT event_id, CASE WHEN error IS NULL
                THEN coalesce(x.exchange, r.venue || '/' || r.market) END AS exchange, error
            FROM (SELECT *, CASE WHEN lower(venue) = 'kraken'
                    THEN 'unknown venue: ''kraken''' WHEN market = 'futures'
                    THEN 'unknown market kind: ''futures'' (expected spot, linear, or inverse)'
                    END AS error
                FROM (SELECT event_id, (['binance', 'Bybit', 'mexc', 'HYPERLIQUID', 'okex',
                    'kraken', 'binance'])[user_id % 7 + 1] AS venue,
                    (['spot', 'linear', 'inverse', 'Spot', 'futures'])[event_id % 5 + 1]
                    AS market FROM events)) r
            LEFT JOIN exchanges x
            ON x.venue = lower(r.venue) AND x.market = lower(r.market)""",
        ),
        "count_trades": _trades("SELECT count(*) AS trades FROM trades"),
        "pair_bounds": _with("raw trades bounds", "SELECT * FROM bounds"),
        "pair_bounds_by_day": _with("raw trades bounds", "SELECT * FROM bounds"),
        "oldest_trades": _trades(f"SELECT * FROM trades {_OLDEST_FIRST} LIMIT 5000"),
        "pairs": _with("raw trades bounds pairs", "SELECT * FROM pairs"),
        "pairs_stored": _with("raw trades bounds pairs", "SELECT * FROM pairs"),
        "pairs_live": _with("raw trades bounds pairs", "SELECT * FROM pairs"),
        "pairs_json": _with(
            "raw trades bounds pairs",
            """SELECT pos, '{"ticker":"' || replace(exchange, ' ', '') || ':' || symbol
            || '","earliest":' || coalesce(CAST(earliest AS VARCHAR), 'null')
            || ',"latest":' || coalesce(CAST(latest AS VARCHAR), 'null') || '}' AS json
            FROM pairs""",
        ),
        "tracked_counts": _with(
            resolve,
            """SELECT count(*) AS tracked_count, count(DISTINCT exchange) AS exchange_count
            FROM resolved""",
        ),
        "ticker_format": f"""SELECT p_partkey, exchange, CASE
                WHEN exchange IN ('Binance Spot', 'Binance Linear', 'Bybit Spot',
                    'Bybit Linear', 'Bybit Inverse', 'Mexc Spot') THEN b || q
                WHEN exchange = 'Binance Inverse' THEN b || q || '_PERP'
                WHEN exchange IN ('Mexc Linear', 'Mexc Inverse') THEN b || '_' || q
                WHEN exchange = 'Okex Spot' THEN b || '-' || q
                WHEN exchange IN ('Okex Linear', 'Okex Inverse') THEN b || '-' || q || '-SWAP'
                ELSE b END AS ticker
            FROM (SELECT p_partkey, {_any('p_partkey')} AS exchange,
                upper(split_part(p_name, ' ', 1)) AS b,
                upper(split_part(p_name, ' ', 2)) AS q FROM part)""",
        "whitelist_templates": _with("whitelist", "SELECT * FROM whitelist"),
        "whitelist_exchanges": _with(
            "exchanges whitelist",
            """SELECT config_id, venue, string_agg(exchange, ',' ORDER BY exchange) AS exchanges
            FROM (SELECT DISTINCT config_id, x.venue, exchange FROM whitelist w
                JOIN exchanges x ON x.venue = lower(w.venue) AND x.market = lower(w.market))
            GROUP BY ALL""",
        ),
        "discovery_exchanges": _with(
            "exchanges whitelist",
            """SELECT venue, string_agg(exchange, ',' ORDER BY exchange) AS exchanges
            FROM exchanges WHERE venue IN (SELECT lower(venue) FROM whitelist) GROUP BY ALL""",
        ),
        "resolve_pairs": _with(resolve, "SELECT * FROM resolved"),
        "exchange_symbols": _with(
            "exchanges catalog",
            f"""SELECT exchange, {shown} AS symbol, count(*) AS listed FROM catalog
            GROUP BY ALL""",
        ),
        "exchange_symbol_lists": _with(
            "exchanges catalog",
            f"""SELECT exchange, string_agg({shown}, ',' ORDER BY {shown}) AS symbols
            FROM catalog GROUP BY ALL""",
        ),
        "upsert_latest": f"""SELECT exchange, symbol, min_ticksize, min_qty, contract_size
            FROM (SELECT *, {_traded('l_suppkey')} AS exchange,
                't' || (l_partkey % 500) AS symbol, -l_linenumber AS min_ticksize,
                CAST(-(l_suppkey % 5) AS INTEGER) AS min_qty,
                CAST(CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 4 END AS INTEGER)
                    AS contract_size FROM lineitem)
            QUALIFY row_number() OVER (PARTITION BY exchange, symbol ORDER BY
                l_orderkey % 2 DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
                l_suppkey DESC, l_extendedprice DESC) = 1""",
        "metadata_upsert": _with("metadata", "SELECT * FROM metadata"),
        "metadata_get": _with(
            "metadata", "SELECT value FROM metadata WHERE key = 'last_cleanup'"
        ),
        "retention_keep": _trades(f"SELECT * FROM trades WHERE ts >= {_CUTOFF}"),
        "retention_deleted": _trades(
            f"SELECT count(*) AS deleted FROM trades WHERE ts < {_CUTOFF}"
        ),
        "purge_plan": """SELECT *, CAST(CASE WHEN size_bytes <= target_bytes THEN 0
                ELSE greatest(0, row_count - max_rows) END AS BIGINT) AS to_delete
            FROM (SELECT *, target_bytes // bytes_per_row AS max_rows
            FROM (SELECT *, CASE WHEN row_count = 0 THEN 50
                    ELSE least(50, greatest(1, size_bytes // row_count)) END AS bytes_per_row,
                least(cap_bytes, greatest(104857600, cap_bytes
                    - least(cap_bytes // 5, 10737418240))) AS target_bytes
            FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * 4000 AS size_bytes,
                (o_custkey * 7919) % 60000 * (1 + o_orderkey % 1000) AS row_count,
                CASE WHEN o_orderkey % 50 = 0 THEN CAST(64424509440 AS BIGINT)
                    ELSE (1 + o_orderkey % 100) * 7340032 END AS cap_bytes FROM orders)))""",
        "purge_keep": _trades(
            f"""SELECT exchange, symbol, ts, price, qty, is_sell FROM (SELECT *,
                row_number() OVER ({_OLDEST_FIRST}) AS nth, count(*) OVER () AS n
                FROM trades) WHERE nth > {_SIZE_RULE}"""
        ),
        "cleanup_pass": _trades(
            f"""SELECT (SELECT count(*) FROM trades WHERE ts < {_CUTOFF}) AS deleted_by_age,
                CAST(max({_SIZE_RULE}) AS BIGINT) AS deleted_by_size,
                count(*) FILTER (WHERE nth > {_SIZE_RULE}) AS kept,
                min(ts) FILTER (WHERE nth > {_SIZE_RULE}) AS oldest_kept,
                '{NOW_MS}' AS last_cleanup
            FROM (SELECT *, row_number() OVER ({_OLDEST_FIRST}) AS nth,
                count(*) OVER () AS n FROM trades WHERE ts >= {_CUTOFF})"""
        ),
        "cleanup_at_startup": _trades(
            """SELECT told.*, n AS row_count, true AS rest_is_there FROM (SELECT count(*) AS n FROM trades),
                (VALUES ('refused', true, CAST(NULL AS BOOLEAN), false), ('halved', false, true, true),
                    ('kept', false, true, false)) AS told("case", refused, as_planned, any_deleted)"""
        ),
        "cleanup_kept": _trades(
            f"""SELECT exchange, symbol, ts, price, qty, is_sell FROM (SELECT *,
                row_number() OVER ({_OLDEST_FIRST}) AS nth, count(*) OVER () AS n
                FROM trades WHERE ts >= {_CUTOFF}) WHERE nth > {_SIZE_RULE}"""
        ),
        "feed_health": feed_answer,
        "feed_health_stream": late_feeds,
        "flush_outcomes": _with(
            "flushed outcomes outcome_events", "SELECT * EXCLUDE (at_ms) FROM outcome_events"
        ),
        "pipeline_health": f"WITH {PARTS['flush_events']}, {health} SELECT * FROM flush_health",
        "pipeline_health_of_outcomes": f"""WITH {PARTS['flushed']}, {PARTS['outcomes']},
            {PARTS['outcome_events']}, {_flushes('outcome_events')}
            SELECT * EXCLUDE (last_flush_at), last_flush_at IS NOT NULL AS flushed
            FROM flush_health""",
        "dropped_trades": _with(
            "drop_events",
            """SELECT node_id,
            CAST(coalesce(sum(n) FILTER (WHERE kind = 'drop' AND stage = 'event_channel'), 0)
                AS BIGINT) AS event_channel_dropped_trades,
            CAST(coalesce(sum(n) FILTER (WHERE kind = 'drop' AND stage = 'persist_channel'), 0)
                AS BIGINT) AS persist_channel_dropped_trades,
            CAST(coalesce(sum(n) FILTER (WHERE kind = 'drop' AND stage = 'data_buffer'), 0)
                AS BIGINT) AS data_buffer_dropped_trades FROM drop_events GROUP BY ALL""",
        ),
        "saturation": _with("drop_events saturation", "SELECT * FROM saturation"),
        "overall_status": f"""WITH {PARTS['flush_events']}, {health},
            {PARTS['drop_events']}, {PARTS['saturation']}, {PARTS['feed_events']},
            {_feeds('feeds', 'node_id, exchange')}, {_STATUS}""",
        "pipeline_health_stream": f"""WITH {PARTS['flush_events']}, {late_health}
            SELECT * FROM flush_health""",
        "overall_status_stream": f"""WITH {PARTS['flush_events']}, {late_health},
            {PARTS['drop_events']}, {PARTS['saturation'].replace('ORDER BY at_ms', f'ORDER BY {_BATCH}, at_ms')},
            {PARTS['feed_events']}, {_feeds('feeds', 'node_id, exchange', f'{_BATCH}, at_ms, seq')},
            {_STATUS}""",
        "access_counts": _access(
            f"SELECT node_id, {_COUNTERS} FROM access_events GROUP BY ALL"
        ),
        "access_summary": summary,
        "access_summary_stream": summary,
        "access_sample": sample,
        "access_sample_stream": recursive
        + _arrived("access_events", "node_id")
        + ", "
        + _sample("arrived", "came", in_turn),
        "rate_limit_flags": f"{limiter} {flags}",
        "rate_limit_loopback": f"""{limiter} SELECT seq, client, at_ms, client % 5 = 0 AS loopback,
            allowed OR client % 5 = 0 AS allowed FROM walk""",
        "rate_limit_stream": recursive
        + _arrived("access_events", "client")
        + ", "
        + _limiter("arrived", "came", in_turn)
        + flags,
    }
