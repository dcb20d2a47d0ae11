"""Connection health of feeds, folded from their event log.

The state after an event depends on the event alone, so only two counters need to
know the event before: reconnects and disconnects. Each stretch of the log is
folded to one partial row per feed; partials of consecutive stretches merge into
one, in any grouping. A batch run uses slices of time as stretches, a stream uses
its micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.operators.stretches import Stretches
from tradelake.session import written

#: Changes of a feed that one task folds, as far as they spread over its time.
ROWS_PER_STRETCH = 1_000_000
STATES = {
    "connected": "connected",
    "disconnected": "reconnecting",
    "restarting": "reconnecting",
    "stopped": "stopped",
}
COUNTERS = [
    "disconnect_count",
    "failed_connect_attempts",
    "reconnect_count",
    "stream_restart_count",
]
#: A partial, after the key columns.
PARTIAL = (
    "stretch bigint, first_kind string, state string, last_error string, "
    "connected_at bigint, last_data_at bigint, " + ", ".join(f"{n} bigint" for n in COUNTERS)
)


def per_exchange(events: DataFrame) -> DataFrame:
    """One row per distinct exchange of events that list several (``exchanges``)."""
    rest = [name for name in events.columns if name != "exchanges"]
    return events.select(
        *rest, F.explode(F.array_distinct("exchanges")).alias("exchange")
    )


def _state(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair])[kind]


def _ones(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("bigint")


def stretch_partials(changes: DataFrame, keys: list[str], stretch: str) -> DataFrame:
    """Fold the state-changing events of each stretch.

    The first change of a stretch is not counted yet, because what came before it
    is not known here; ``first_kind`` keeps it for the merge.
    """
    order = Window.partitionBy(stretch, *keys).orderBy("at_ms", "seq")
    kind = F.col("kind")
    seen = changes.withColumn("_before", F.lag(_state(kind)).over(order))
    before, known = F.col("_before"), F.col("_before").isNotNull()
    down = (kind == "disconnected") & known
    place = F.struct("at_ms", "seq")
    folded = seen.groupBy(stretch, *keys).agg(
        F.min_by("kind", place).alias("first_kind"),
        F.max_by(F.struct("kind", "reason"), place).alias("_last"),
        F.max(F.when(kind == "connected", F.col("at_ms"))).alias("connected_at"),
        F.sum(_ones(down & (before == "connected"))).alias("disconnect_count"),
        F.sum(_ones(down & (before != "connected"))).alias("failed_connect_attempts"),
        F.sum(_ones((kind == "connected") & (before == "reconnecting"))).alias(
            "reconnect_count"
        ),
        F.sum(_ones(kind == "restarting")).alias("stream_restart_count"),
    )
    last_kind = F.col("_last.kind")
    return folded.select(
        *keys,
        F.col(stretch).cast("bigint").alias("stretch"),
        "first_kind",
        _state(last_kind).alias("state"),
        F.when(last_kind != "connected", F.col("_last.reason")).alias("last_error"),
        "connected_at",
        F.lit(None).cast("bigint").alias("last_data_at"),
        *COUNTERS,
    )


def data_partials(known: DataFrame, keys: list[str]) -> DataFrame:
    """Partials of the market-data events, which only move ``last_data_at``."""
    text = F.lit(None).cast("string")
    return known.filter("last_data_at IS NOT NULL").select(
        *keys,
        F.lit(0).cast("bigint").alias("stretch"),
        text.alias("first_kind"),
        text.alias("state"),
        text.alias("last_error"),
        F.lit(None).cast("bigint").alias("connected_at"),
        "last_data_at",
        *[F.lit(0).cast("bigint").alias(name) for name in COUNTERS],
    )


def feed_partials(
    events: DataFrame, keys: list[str], rows_per_stretch: int = ROWS_PER_STRETCH
) -> DataFrame:
    """Partials of a whole log in two scans and one shuffle of its changes.

    The first scan finds each feed's last data, and the number and time span of its
    changes; a feed with many has its time cut into stretches of half the given rows or more.
    """
    changing = F.col("kind").isin(list(STATES))
    at = F.when(changing, F.col("at_ms"))
    known = written(
        events.groupBy(*keys).agg(
            F.max(F.when(~changing, F.col("at_ms"))).alias("last_data_at"),
            F.count(at).alias("_n"),
            F.min(at).alias("_low"),
            F.max(at).alias("_high"),
        ),
        "feeds",
    )
    spans = known.select(*[F.col(key).alias(f"_{key}") for key in keys], "_n", "_low", "_high")
    changes = events.filter(changing).select(*keys, "at_ms", "seq", "kind", "reason")
    cut = Stretches(changes, keys, max(rows_per_stretch // 2, 1), spans).place(changes)
    cut = cut.withColumnRenamed("chunk", "stretch")
    return stretch_partials(cut, keys, "stretch").unionByName(data_partials(known, keys))


def merge_partials(partials: DataFrame, keys: list[str]) -> DataFrame:
    """One partial per feed from those of consecutive stretches."""
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("stretch")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = partials.withColumn("_before", F.last("state", ignorenulls=True).over(earlier))
    before, known = F.col("_before"), F.col("_before").isNotNull()
    first = F.col("first_kind")
    down = known & (first == "disconnected")
    changed = F.when(F.col("state").isNotNull(), F.col("stretch"))
    now_counted = {
        "disconnect_count": _ones(down & (before == "connected")),
        "failed_connect_attempts": _ones(down & (before != "connected")),
        "reconnect_count": _ones(
            known & (first == "connected") & (before == "reconnecting")
        ),
    }
    merged = seen.groupBy(*keys).agg(
        F.max("stretch").alias("stretch"),
        F.min_by("first_kind", changed).alias("first_kind"),
        F.max_by(F.struct("state", "last_error"), changed).alias("_last"),
        F.max("connected_at").alias("connected_at"),
        F.max("last_data_at").alias("last_data_at"),
        *[
            F.sum(F.col(name) + now_counted.get(name, F.lit(0))).alias(name)
            for name in COUNTERS
        ],
    )
    return merged.select(
        *keys,
        "stretch",
        "first_kind",
        F.col("_last.state").alias("state"),
        F.col("_last.last_error").alias("last_error"),
        "connected_at",
        "last_data_at",
        *COUNTERS,
    )


def health_of(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Feed health from partials; every feed begins in state ``starting``."""
    merged = merge_partials(partials, keys)
    failed_first = _ones(F.col("first_kind") == "disconnected")
    return merged.select(
        *keys,
        F.coalesce("state", F.lit("starting")).alias("state"),
        "connected_at",
        "last_data_at",
        "last_error",
        "disconnect_count",
        (F.col("failed_connect_attempts") + failed_first).alias("failed_connect_attempts"),
        "reconnect_count",
        "stream_restart_count",
    )


def feed_health(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Health of every feed that has events, keyed by ``exchange`` by default."""
    keys = keys or ["exchange"]
    return health_of(feed_partials(events, keys), keys)


def with_persisted(feeds: DataFrame, flushes: DataFrame) -> DataFrame:
    """Add ``last_persist_at`` from a log of committed (exchange, flushed_at).

    A feed known only from a commit appears as ``starting``.
    """
    last = flushes.groupBy("exchange").agg(F.max("flushed_at").alias("last_persist_at"))
    joined = feeds.join(last, "exchange", "full_outer")
    return _started(joined)


def with_registered(feeds: DataFrame, registered: DataFrame) -> DataFrame:
    """Add registered exchanges that have been silent so far."""
    joined = feeds.join(registered.select("exchange").distinct(), "exchange", "full_outer")
    return _started(joined)


def _started(feeds: DataFrame) -> DataFrame:
    filled = feeds.withColumn("state", F.coalesce("state", F.lit("starting")))
    for name in COUNTERS:
        filled = filled.withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    return filled
