"""Fixed schemas. Times are epoch milliseconds in UTC."""

TRADES = (
    "exchange string, symbol string, ts bigint, price double, qty double, is_sell boolean"
)
TRADE_COLUMNS = ["exchange", "symbol", "ts", "price", "qty", "is_sell"]
# Trades as stored: the six columns, the batch they came with, and the period.
STORED_TRADES = (
    "exchange string, symbol string, ts bigint, price double, qty double, is_sell boolean, "
    "source string, batch_id bigint, flushed_at bigint, dt date"
)
# One row per period and pair.
FLUSH_LOG = (
    "exchange string, symbol string, trades bigint, earliest bigint, latest bigint, "
    "flushed_at bigint, dt date"
)
ANSWER_COLUMNS = ["ts", "price", "qty", "is_sell"]
MARKET_EVENTS = (
    "seq bigint, at_ms bigint, exchange string, kind string, "
    "trades array<struct<ticker: string, display_symbol: string, ts: bigint, "
    "price: double, qty: double, is_sell: boolean>>"
)
TICKER_INFO = (
    "exchange string, symbol string, min_ticksize int, min_qty int, contract_size int"
)
