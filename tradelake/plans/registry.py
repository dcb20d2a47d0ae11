"""The registered queries. Each takes (spark, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.times import DAY_MS, HOUR_MS, utc_day
from tradelake.operators import access, admission, bounds, feeds, pipeline, reads, retention
from tradelake.operators import catalog as cat
from tradelake.operators.upserts import latest, metadata_value, store_ticker_infos, upsert
from tradelake.plans import tables as t
from tradelake.schemas import TICKER_INFO, TRADE_COLUMNS
from tradelake.session import prepare, scratch_path
from tradelake.sources import exports
from tradelake.sources.exchanges import exchanges, with_exchange_filter
from tradelake.sources.table import MetadataTable, TradeTable
from tradelake.sources.whitelist import whitelist_rows
from tradelake.streaming import access as access_stream
from tradelake.streaming import health as health_stream
from tradelake.streaming import ingest
from tradelake.streaming import pairs as pairs_stream
from tradelake.streaming.outcomes import FlushLog, supervise, write_attempts

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

NOW_MS = 1_000_000_000_000
HOURS = 3 * 365 * 24
FROM_MS, TO_MS = 883_612_800_000, 946_684_800_000
SIX_HOURS = 6 * HOUR_MS
TWO_DAYS = 2 * DAY_MS


def registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    _QUERIES[query.__name__] = run
    return query


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.normalize_trades(t.raw_trades(t.given(spark, sf_dir, "lineitem")))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.given(spark, sf_dir, "events")


def _whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitelist_rows(t.whitelist_configs(t.given(spark, sf_dir, "customer")))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.catalog(t.given(spark, sf_dir, "part"))


def _arriving(spark: SparkSession, batches: list[DataFrame], root: str, start) -> None:
    """Run a stream over batches that arrive one after the other, stopping in between."""
    path = f"{root}/arrived"
    for batch in batches:
        batch.write.mode("append").parquet(path)
        stream = spark.readStream.schema(batch.schema).parquet(path)
        start(stream, f"{root}/offsets").awaitTermination()


# Ingest


@registered
def normalize_trades(spark, sf_dir):
    return _trades(spark, sf_dir)


@registered
def route_trades(spark, sf_dir):
    return reads.route_trades(t.market_events(t.given(spark, sf_dir, "lineitem")))


def _ingested(spark, sf_dir) -> TradeTable:
    """Two venues' streams in one table, over several batches and restarts.

    These trades spread over years, a few per day: yearly periods fit them.
    """
    root = scratch_path(spark, "ingest")
    table = TradeTable(spark, f"{root}/table", "year")
    events = t.market_events(t.given(spark, sf_dir, "lineitem"))
    binance = F.col("exchange").startswith("Binance")
    for name, own in (("binance", events.filter(binance)), ("others", events.filter(~binance))):
        parts = [own.filter(F.pmod("seq", F.lit(2)) == n) for n in (0, 1)]
        _arriving(
            spark, parts, f"{root}/{name}", lambda s, c: ingest.start_ingest(s, table, c, until_caught_up=True)
        )
        table.settle()
    return table


@registered
def ingest_trades(spark, sf_dir):
    return _ingested(spark, sf_dir).read().select(*TRADE_COLUMNS)


@registered
def ingest_merged(spark, sf_dir):
    """Both venues as one stream, whose batches have landed but are not settled."""
    root = scratch_path(spark, "merged")
    table = TradeTable(spark, f"{root}/table", "year")
    events = t.market_events(t.given(spark, sf_dir, "lineitem"))
    binance = F.col("exchange").startswith("Binance")

    def start(stream, checkpoint):
        both = ingest.merge_streams(stream.filter(binance), stream.filter(~binance))
        return ingest.start_ingest(both, table, checkpoint, until_caught_up=True)

    _arriving(spark, [events], root, start)
    return table.read().select(*TRADE_COLUMNS)


@registered
def ingest_dead_letters(spark, sf_dir):
    """Messages that are no events, and the trades of those that are, counted."""
    root = scratch_path(spark, "dead")
    table = TradeTable(spark, f"{root}/table", "year")
    _arriving(
        spark,
        [t.messages(t.given(spark, sf_dir, "lineitem"))],
        root,
        lambda s, c: ingest.start_ingest(ingest.parse_events(s), table, c, until_caught_up=True),
    )
    dead = ingest.dead_letters(spark, table).select("unparsed", F.lit(0).alias("stored"))
    stored = table.read().select(F.lit(None).cast("string").alias("unparsed"), F.lit(1).alias("stored"))
    return dead.union(stored).groupBy("unparsed").agg(F.sum("stored").alias("trades"), F.count("*").alias("n"))


@registered
def ingest_rejects(spark, sf_dir):
    """Trades with a null are kept apart, with the batch they came with."""
    table = TradeTable(spark, scratch_path(spark, "rejects"), "year")
    trades = _trades(spark, sf_dir)
    broken = trades.withColumn("price", F.when(F.col("qty") != 7, F.col("price")))
    table.append(broken, 0, NOW_MS)
    table.settle()
    table.append(broken.limit(0), 1, NOW_MS)
    return table.read_rejects().select(*TRADE_COLUMNS, "source", "batch_id")


@registered
def batch_exchanges(spark, sf_dir):
    weekly = _trades(spark, sf_dir).withColumn("batch_id", F.expr(f"ts div {7 * DAY_MS}L"))
    return reads.batch_exchanges(weekly)


# Reads


@registered
def trades_range_asc(spark, sf_dir):
    query = reads.TradeQuery("binance", "BTCUSDT", "spot", FROM_MS, TO_MS)
    return reads.read_trades(_trades(spark, sf_dir), query)


@registered
def trades_latest_desc(spark, sf_dir):
    query = reads.TradeQuery("Binance", "btcusdt", "spot", limit=25_000)
    return reads.read_trades(_trades(spark, sf_dir), query)


@registered
def trades_to_only(spark, sf_dir):
    query = reads.TradeQuery("bybit", "ethusdt", "linear", to_ms=TO_MS, limit=100)
    return reads.read_trades(_trades(spark, sf_dir), query)


@registered
def trades_unsupported_pair(spark, sf_dir):
    query = reads.TradeQuery("hyperliquid", "btcusdt", "inverse")
    return reads.read_trades(_trades(spark, sf_dir), query)


@registered
def trades_export(spark, sf_dir):
    query = reads.TradeQuery("okex", "xrpusdt", "linear", from_ms=FROM_MS)
    return reads.export_trades(_trades(spark, sf_dir), query)


@registered
def trades_export_files(spark, sf_dir):
    """All trades written as time-ordered files, read back."""
    path = scratch_path(spark, "export")
    exports.write_export(_trades(spark, sf_dir), path)
    return spark.read.parquet(path)


@registered
def trades_arrow_streams(spark, sf_dir):
    """A pair's trades as Arrow IPC streams, read back."""
    query = reads.TradeQuery("binance", "btcusdt", "spot")
    streams = exports.arrow_streams(reads.export_trades(_trades(spark, sf_dir), query), 500, 1_000)
    return exports.read_arrow_streams(streams)


@registered
def trades_export_stats(spark, sf_dir):
    """What the export reports: rows written, and rows in its files and streams."""
    path = scratch_path(spark, "export")
    trades = _trades(spark, sf_dir)
    stats = exports.write_export(trades, path)
    streamed = exports.stream_stats(exports.arrow_streams(trades))
    counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_read"))
    return counted.select(
        F.lit(stats.rows).cast("bigint").alias("rows_written"),
        "rows_read",
        F.lit(streamed.rows).cast("bigint").alias("rows_streamed"),
        F.lit(stats.batches > 0 and streamed.batches > 0).alias("any_batches"),
    )


@registered
def trades_stored_latest(spark, sf_dir):
    """The newest rows of a pair from the stored table, reading few periods."""
    table = TradeTable(spark, scratch_path(spark, "stored"), "year")
    table.append(_trades(spark, sf_dir), batch_id=0, flushed_at=NOW_MS)
    table.settle()
    return table.read_trades(reads.TradeQuery("bybit", "solusdt", "spot", limit=50))


@registered
def trades_json(spark, sf_dir):
    """Trades written as JSON text and read back."""
    written = exports.trades_json(_trades(spark, sf_dir))
    parsed = written.select(
        "exchange", "symbol", F.from_json("json", exports.TRADE_JSON).alias("trade")
    )
    return parsed.select("exchange", "symbol", "trade.*")


@registered
def venue_market_exchange(spark, sf_dir):
    requests = t.read_requests(_events(spark, sf_dir))
    return with_exchange_filter(requests).select("event_id", "exchange", "error")


@registered
def count_trades(spark, sf_dir):
    return bounds.count_trades(_trades(spark, sf_dir))


@registered
def pair_bounds(spark, sf_dir):
    return bounds.pair_bounds(_trades(spark, sf_dir))


@registered
def pair_bounds_by_day(spark, sf_dir):
    """Bounds kept per day, as the flush log keeps them, merged into one row a pair."""
    daily = (
        _trades(spark, sf_dir)
        .groupBy(utc_day(F.col("ts")).alias("day"), "exchange", "symbol")
        .agg(F.min("ts").alias("earliest"), F.max("ts").alias("latest"))
    )
    return bounds.merge_bounds(daily.drop("day"))


@registered
def oldest_trades(spark, sf_dir):
    return retention.oldest_trades(_trades(spark, sf_dir), 5_000)


# Which pairs to track


@registered
def pairs(spark, sf_dir):
    wanted = t.configured(t.given(spark, sf_dir, "part"))
    return bounds.configured_pairs(wanted, bounds.pair_bounds(_trades(spark, sf_dir)))


@registered
def pairs_stored(spark, sf_dir):
    """The same answer from the stored table's flush log, half of it settled."""
    table = TradeTable(spark, scratch_path(spark, "bounds"), "year")
    trades = _trades(spark, sf_dir)
    early = F.col("ts") % 2 == 0
    table.append(trades.filter(early), 0, NOW_MS)
    table.settle()
    table.append(trades.filter(~early), 1, NOW_MS)
    wanted = t.configured(t.given(spark, sf_dir, "part"))
    return bounds.configured_pairs(wanted, table.read_bounds())


@registered
def pairs_live(spark, sf_dir):
    """The same answer from a stream of trades in several batches, with restarts."""
    root = scratch_path(spark, "live")
    trades = _trades(spark, sf_dir)
    parts = [trades.filter(F.pmod("ts", F.lit(3)) == n) for n in range(3)]
    _arriving(spark, parts, root, lambda s, c: pairs_stream.start_pair_bounds(s, c, until_caught_up=True))
    wanted = t.configured(t.given(spark, sf_dir, "part"))
    return pairs_stream.live_pairs(spark, f"{root}/offsets", wanted)


@registered
def pairs_json(spark, sf_dir):
    answer = exports.pairs_json(pairs(spark, sf_dir))
    return answer.select("pos", "json")


@registered
def tracked_counts(spark, sf_dir):
    return bounds.tracked_counts(resolve_pairs(spark, sf_dir))


@registered
def ticker_format(spark, sf_dir):
    candidates = cat.candidate_tickers(
        t.given(spark, sf_dir, "part").selectExpr(
            "p_partkey",
            f"{t.any_exchange('p_partkey')} AS exchange",
            "split(p_name, ' ')[0] AS base",
            "split(p_name, ' ')[1] AS quote",
        )
    )
    return candidates.select("p_partkey", "exchange", "ticker")


@registered
def whitelist_templates(spark, sf_dir):
    return _whitelist(spark, sf_dir)


@registered
def whitelist_exchanges(spark, sf_dir):
    wanted = cat.whitelist_exchanges(_whitelist(spark, sf_dir), ["config_id"])
    return wanted.withColumn("exchanges", F.concat_ws(",", "exchanges"))


@registered
def discovery_exchanges(spark, sf_dir):
    """Discovery mode, for the venues that the whitelists name."""
    venues = _whitelist(spark, sf_dir).select(F.lower("venue").alias("venue")).distinct()
    found = cat.all_exchanges(spark).join(venues, "venue", "left_semi")
    return found.withColumn("exchanges", F.concat_ws(",", "exchanges"))


@registered
def resolve_pairs(spark, sf_dir):
    assets = t.bases(t.given(spark, sf_dir, "customer"))
    return cat.resolve_pairs(assets, _whitelist(spark, sf_dir), _catalog(spark, sf_dir))


@registered
def exchange_symbols(spark, sf_dir):
    return cat.exchange_symbols(_catalog(spark, sf_dir))


@registered
def exchange_symbol_lists(spark, sf_dir):
    lists = cat.exchange_symbol_lists(_catalog(spark, sf_dir))
    return lists.withColumn("symbols", F.concat_ws(",", "symbols"))


# Changes to tables


@registered
def upsert_latest(spark, sf_dir):
    updates = t.ticker_updates(t.given(spark, sf_dir, "lineitem"))
    nothing = spark.createDataFrame([], TICKER_INFO)
    stored = store_ticker_infos(nothing, updates.filter("NOT is_new"), "place")
    return store_ticker_infos(stored, updates.filter("is_new"), "place")


@registered
def metadata_upsert(spark, sf_dir):
    written = t.metadata_log(_events(spark, sf_dir))
    old = latest(written.filter("NOT is_new").drop("is_new"), ["key"], "seq")
    return upsert(old, written.filter("is_new").drop("is_new"), ["key"], "seq")


@registered
def metadata_get(spark, sf_dir):
    return metadata_value(metadata_upsert(spark, sf_dir), "last_cleanup")


@registered
def retention_keep(spark, sf_dir):
    return retention.retention_keep(_trades(spark, sf_dir), NOW_MS, HOURS)


@registered
def retention_deleted(spark, sf_dir):
    return retention.retention_deleted(_trades(spark, sf_dir), NOW_MS, HOURS)


@registered
def purge_plan(spark, sf_dir):
    return retention.with_purge_plan(t.table_sizes(t.given(spark, sf_dir, "orders")))


@registered
def purge_keep(spark, sf_dir):
    """The newest three fifths."""
    trades = _trades(spark, sf_dir)
    rows = trades.count()
    return retention.purge_keep(trades, rows - rows * 3 // 5)


BYTES_PER_ROW = 50


@registered
def cleanup_pass(spark, sf_dir):
    """A pass on a stored table: age rule, size rule, and the time it records."""
    root = scratch_path(spark, "cleanup")
    table = TradeTable(spark, f"{root}/table", "year")
    metadata = MetadataTable(spark, f"{root}/metadata")
    trades = _trades(spark, sf_dir)
    table.append(trades, 0, NOW_MS)
    left = retention.retention_keep(trades, NOW_MS, HOURS).count()
    cap = left * BYTES_PER_ROW * 3 // 5
    done = retention.run_cleanup(table, metadata, NOW_MS, HOURS, cap, BYTES_PER_ROW)
    summary = table.read().agg(
        F.count(F.lit(1)).alias("kept"), F.min("ts").alias("oldest_kept")
    )
    return summary.select(
        F.lit(done.deleted_by_age).cast("bigint").alias("deleted_by_age"),
        F.lit(done.deleted_by_size).cast("bigint").alias("deleted_by_size"),
        "kept",
        "oldest_kept",
        F.lit(metadata.get("last_cleanup")).alias("last_cleanup"),
    )


@registered
def cleanup_kept(spark, sf_dir):
    """The rows that such a pass leaves."""
    table = TradeTable(spark, scratch_path(spark, "kept"), "year")
    trades = _trades(spark, sf_dir)
    table.append(trades, 0, NOW_MS)
    retention.purge_by_age(table, NOW_MS, HOURS)
    left = table.read().count()
    retention.purge_by_size(table, left * BYTES_PER_ROW * 3 // 5, BYTES_PER_ROW)
    return table.read().select(*TRADE_COLUMNS)


@registered
def cleanup_at_startup(spark, sf_dir):
    """First passes under three caps, by what the stored files and the flush log say: more
    than half the table too small, exactly half, and room for all."""
    trades, found = _trades(spark, sf_dir), []
    for case, cap_of in (
        ("refused", lambda size: (size - 1) // 2),
        ("halved", lambda size: (size + 1) // 2),
        ("kept", lambda size: size),
    ):
        root = scratch_path(spark, "startup")
        table = TradeTable(spark, f"{root}/table", "year")
        table.append(trades, 0, NOW_MS)
        table.settle()
        size, cap = table.stored_bytes(), cap_of(table.stored_bytes())
        counted = table.read_flushes().agg(F.sum("trades").alias("row_count"))
        plan = retention.with_purge_plan(counted.selectExpr(f"{size}L AS size_bytes", "row_count", f"{cap}L AS cap_bytes")).first()
        try:
            done = retention.run_cleanup(
                table, MetadataTable(spark, f"{root}/metadata"), NOW_MS, 0, cap, at_startup=True
            )
            deleted, refused = done.deleted_by_size, False
        except ValueError:
            deleted, refused = None, True
        rows = table.read().agg(F.count("*").alias("left")).select(
            F.lit(case).alias("case"),
            F.lit(refused).alias("refused"),
            F.lit(plan["row_count"]).cast("bigint").alias("row_count"),
            # What the pass deleted is what the plan asks for; nothing where it refused.
            (F.lit(deleted).cast("bigint") == plan["to_delete"]).alias("as_planned"),
            (F.col("left") == plan["row_count"] - (deleted or 0)).alias("rest_is_there"),
            F.lit(bool(deleted)).alias("any_deleted"),
        )
        found.append(rows)
    return reduce(DataFrame.unionByName, found)


# Health


def _with_rest(spark, feed_rows, events):
    persisted = feeds.with_persisted(feed_rows, t.commits(events))
    return feeds.with_registered(persisted, exchanges(spark)).orderBy("exchange")


@registered
def feed_health(spark, sf_dir):
    events = _events(spark, sf_dir)
    return _with_rest(spark, feeds.feed_health(t.feed_events(events)), events)


@registered
def feed_health_stream(spark, sf_dir):
    """Over several batches and restarts, with events that come late."""
    root = scratch_path(spark, "feeds")
    events = t.feed_events(_events(spark, sf_dir))
    _arriving(
        spark, t.in_arrival(events), root, lambda s, c: health_stream.start_feed_health(s, f"{root}/health", c)
    )
    rows = health_stream.read_feed_health(spark, f"{root}/health", events)
    return _with_rest(spark, rows, _events(spark, sf_dir))


def _write_attempts(spark, sf_dir) -> DataFrame:
    """What became of the batches of three nodes: node 1 writes at once, node 2 at the
    third attempt, and node 3 gives its first batch up after two."""
    root = scratch_path(spark, "attempts")
    events = t.market_events(t.given(spark, sf_dir, "lineitem"))
    found = []
    for node, (refusals, give_up_after) in t.REFUSALS.items():
        own = events.filter(f"{t.NODE_OF_EXCHANGE} = {node}")
        path = f"{root}/{node}"
        table = t.UnreliableTable(spark, f"{path}/table", "year", {0: refusals})
        log = FlushLog(spark, f"{path}/outcomes", node)

        def start(stream, checkpoint, table=table, log=log, give_up_after=give_up_after):
            def run():
                return ingest.start_ingest(
                    stream, table, checkpoint, until_caught_up=True, log=log, give_up_after=give_up_after
                )

            return supervise(run, restarts=3, pause_s=0, log=log)

        _arriving(spark, [own.filter(F.pmod("seq", F.lit(2)) == n) for n in (0, 1)], path, start)
        log.close()
        found.append(write_attempts(spark, f"{path}/outcomes"))
    return reduce(DataFrame.unionByName, found)


@registered
def flush_outcomes(spark, sf_dir):
    """Flush events of streams that really failed; their times are the clock's."""
    return pipeline.flush_outcome_events(_write_attempts(spark, sf_dir)).drop("at_ms")


@registered
def pipeline_health(spark, sf_dir):
    return pipeline.pipeline_health(t.flush_events(_events(spark, sf_dir)))


@registered
def pipeline_health_of_outcomes(spark, sf_dir):
    events = pipeline.flush_outcome_events(_write_attempts(spark, sf_dir))
    flushed = F.col("last_flush_at").isNotNull().alias("flushed")
    return pipeline.pipeline_health(events).select("*", flushed).drop("last_flush_at")


@registered
def dropped_trades(spark, sf_dir):
    return pipeline.dropped_trades(t.drop_events(_events(spark, sf_dir)))


@registered
def saturation(spark, sf_dir):
    return pipeline.saturation(t.drop_events(_events(spark, sf_dir)))


@registered
def overall_status(spark, sf_dir):
    events = _events(spark, sf_dir)
    return pipeline.overall_status(
        pipeline.pipeline_health(t.flush_events(events)),
        pipeline.saturation(t.drop_events(events)),
        feeds.feed_health(t.feed_events(events), ["node_id", "exchange"]),
        database_ok=F.col("node_id") != 3,
    )


@registered
def pipeline_health_stream(spark, sf_dir):
    """Over several batches and restarts, with events that come late."""
    root = scratch_path(spark, "flushes")
    events = t.flush_events(_events(spark, sf_dir))
    _arriving(
        spark, t.in_arrival(events), root, lambda s, c: health_stream.start_pipeline_health(s, f"{root}/health", c)
    )
    return health_stream.read_pipeline_health(spark, f"{root}/health", events)


@registered
def overall_status_stream(spark, sf_dir):
    """Three streams per node, each in batches of its own, with events that come late."""
    root, source = scratch_path(spark, "status"), _events(spark, sf_dir)
    events = {"flushes": t.flush_events(source), "drops": t.drop_events(source), "feeds": t.feed_events(source)}
    paths = {name: f"{root}/{name}/state" for name in events}
    starts = {
        "flushes": health_stream.start_pipeline_health,
        "drops": health_stream.start_saturation,
        "feeds": partial(health_stream.start_feed_health, keys=["node_id", "exchange"]),
    }
    for name, start in starts.items():
        _arriving(
            spark, t.in_arrival(events[name]), f"{root}/{name}", lambda s, c, n=name, go=start: go(s, paths[n], c)
        )
    return health_stream.read_overall_status(spark, paths, events, database_ok=F.col("node_id") != 3)


# Access


@registered
def access_counts(spark, sf_dir):
    return access.access_counts(t.access_events(_events(spark, sf_dir)))


@registered
def access_summary(spark, sf_dir):
    events = t.access_events(_events(spark, sf_dir))
    return access.access_summary(events, t.FIRST_MS, SIX_HOURS)


@registered
def access_summary_stream(spark, sf_dir):
    root = scratch_path(spark, "summary")
    events = t.access_events(_events(spark, sf_dir))

    def start(stream, checkpoint):
        return access_stream.start_summary(stream, f"{root}/out", checkpoint, t.FIRST_MS, SIX_HOURS)

    _arriving(spark, t.in_arrival(events), root, start)
    return access_stream.read_summary(spark, f"{root}/out", events)


@registered
def access_sample(spark, sf_dir):
    events = t.access_events(_events(spark, sf_dir))
    return access.access_sample(events, t.FIRST_MS, SIX_HOURS, limit=3)


@registered
def access_sample_stream(spark, sf_dir):
    root = scratch_path(spark, "sample")
    events = t.access_events(_events(spark, sf_dir))

    def start(stream, checkpoint):
        return access_stream.start_access_sample(
            stream, f"{root}/out", checkpoint, t.FIRST_MS, SIX_HOURS, limit=3
        )

    _arriving(spark, t.in_arrival(events), root, start)
    columns = (
        "seq bigint, node_id bigint, client bigint, at_ms bigint, kind string, "
        "window_start_ms bigint, nth bigint"
    )
    return access_stream.read_answers(spark, f"{root}/out", columns)


@registered
def rate_limit_flags(spark, sf_dir):
    requests = t.access_events(_events(spark, sf_dir)).select("seq", "client", "at_ms")
    return admission.rate_limit_flags(requests, 3, TWO_DAYS)


@registered
def rate_limit_loopback(spark, sf_dir):
    """Requests of the machine itself always pass."""
    requests = t.access_events(_events(spark, sf_dir)).selectExpr(
        "seq", "client", "at_ms", "client % 5 = 0 AS loopback"
    )
    return admission.rate_limit_flags(requests, 3, TWO_DAYS)


@registered
def rate_limit_stream(spark, sf_dir):
    root = scratch_path(spark, "limit")
    requests = t.access_events(_events(spark, sf_dir)).select("seq", "client", "at_ms")

    def start(stream, checkpoint):
        return access_stream.start_rate_limit(
            stream, f"{root}/out", checkpoint, 3, TWO_DAYS, idle_ms=365 * 24 * HOUR_MS
        )

    _arriving(spark, t.in_arrival(requests), root, start)
    columns = "seq bigint, client bigint, at_ms bigint, allowed boolean"
    return access_stream.read_answers(spark, f"{root}/out", columns)
