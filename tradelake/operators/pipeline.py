"""Health of the write path, folded from flush and overload logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.session import written

STAGES = ["event_channel", "persist_channel", "data_buffer"]


def flush_outcome_events(outcomes: DataFrame) -> DataFrame:
    """Flush events of write attempts with an ``outcome`` and ``n`` trades.

    A crashed write loses its trades: it fails with nothing kept, then drops them.
    A final write that fails or crashes counts its trades as failed, then drops
    them.
    """
    def event(kind: str, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), n.cast("bigint").alias("n"))

    n, none = F.col("n"), F.lit(0)
    steps = (
        F.when(F.col("outcome") == "success", F.array(event("ok", none)))
        .when(F.col("outcome") == "retry_success", F.array(event("retry_ok", none)))
        .when(F.col("outcome") == "failure", F.array(event("failed", n)))
        .when(
            F.col("outcome") == "crash",
            F.array(event("failed", none), event("dropped", n)),
        )
        .when(
            F.col("outcome").isin("final_failure", "final_crash"),
            F.array(event("failed", n), event("dropped", n)),
        )
    )
    expanded = outcomes.select(
        "seq", "node_id", "at_ms", "error", F.posexplode(steps).alias("step", "event")
    )
    return expanded.select(
        (F.col("seq") * 2 + F.col("step")).alias("seq"),
        "node_id",
        "at_ms",
        "event.kind",
        "event.n",
        "error",
    )


def pipeline_health(events: DataFrame) -> DataFrame:
    """Write health per node.

    Written as aggregates instead of a walk through each node's log:

    * once trades have been dropped, nothing makes a node healthy again;
    * until then, the last event other than ``ok`` decides, together with whether
      an ``ok`` follows it while nothing is pending;
    * the last error is that of the last ``failed`` unless a later ``retry_ok``, or
      an ``ok`` with nothing pending and nothing dropped, clears it.
    """
    kind, n = F.col("kind"), F.col("n")
    place = F.struct("at_ms", "seq")
    found = events.groupBy("node_id").agg(
        F.max(F.when(kind.isin("ok", "retry_ok"), F.col("at_ms"))).alias("last_flush_at"),
        F.count_if(kind == "failed").alias("flush_failure_count"),
        F.coalesce(F.sum(F.when(kind == "dropped", n)), F.lit(0)).alias(
            "flush_dropped_trades"
        ),
        F.max_by("kind", place).alias("last_kind"),
        F.max_by(F.struct("kind", "n"), F.when(kind != "ok", place)).alias("told"),
        F.max_by(
            F.struct("at_ms", "seq", "kind", "n", "error"),
            F.when(kind.isin("failed", "retry_ok"), place),
        ).alias("fault"),
        F.min(F.when((kind == "dropped") & (n > 0), place)).alias("first_drop"),
    )
    dropped = F.col("first_drop").isNotNull()
    pending = F.when(F.col("told.kind") == "failed", F.col("told.n")).otherwise(F.lit(0))
    recovered = (
        F.col("told").isNull()
        | (F.col("told.kind") == "retry_ok")
        | ((pending == 0) & (F.col("last_kind") == "ok"))
    )
    summary = found.select(
        "node_id",
        (~dropped & recovered).alias("persistence_healthy"),
        "last_flush_at",
        "flush_failure_count",
        pending.alias("flush_retry_pending_trades"),
        "flush_dropped_trades",
        "fault",
        "first_drop",
    )
    nodes = written(summary, "nodes")
    cleared = _cleared_faults(events, nodes)
    standing = (F.col("fault.kind") == "failed") & F.col("_cleared").isNull()
    return nodes.join(cleared, "node_id", "left").select(
        "node_id",
        "persistence_healthy",
        "last_flush_at",
        F.when(standing, F.col("fault.error")).alias("last_flush_error"),
        "flush_failure_count",
        "flush_retry_pending_trades",
        "flush_dropped_trades",
    )


def _cleared_faults(events: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes whose last failure was cleared by a plain ``ok``.

    Between the failure and the first loss of trades, an ``ok`` clears at once if
    nothing was pending, and otherwise after an empty drop has ended the wait.
    """
    place = F.struct("at_ms", "seq")
    fault = F.struct("fault.at_ms", "fault.seq")
    no_drop = F.col("first_drop").isNull()
    open_faults = nodes.filter(
        (F.col("fault.kind") == "failed") & (no_drop | (fault < F.col("first_drop")))
    ).select("node_id", fault.alias("_fault"), F.col("fault.n").alias("waiting"), "first_drop")
    candidates = events.filter(F.col("kind").isin("ok", "dropped")).select(
        "node_id", "at_ms", "seq", "kind"
    )
    after = candidates.join(open_faults, "node_id").filter(
        (place > F.col("_fault")) & (no_drop | (place < F.col("first_drop")))
    )
    ends = after.groupBy("node_id").agg(
        F.max("waiting").alias("waiting"),
        F.max(F.when(F.col("kind") == "ok", place)).alias("last_ok"),
        F.min(F.when(F.col("kind") == "dropped", place)).alias("wait_over"),
    )
    clears = (F.col("waiting") == 0) & F.col("last_ok").isNotNull() | (
        F.col("last_ok") > F.col("wait_over")
    )
    return ends.filter(clears).select("node_id", F.lit(True).alias("_cleared"))


def dropped_trades(events: DataFrame) -> DataFrame:
    """Trades lost per node and stage; ``n`` is the trades an event carried."""
    lost = [
        F.coalesce(
            F.sum(F.when((F.col("kind") == "drop") & (F.col("stage") == stage), F.col("n"))),
            F.lit(0),
        ).alias(f"{stage}_dropped_trades")
        for stage in STAGES
    ]
    return events.groupBy("node_id").agg(*lost)


def last_signals(events: DataFrame) -> DataFrame:
    """Whether the last event of each latch was a drop (``set``).

    The event channel of a node has one latch per exchange, the other stages one each.
    """
    latch = F.when(F.col("stage") == "event_channel", F.col("exchange")).alias("latch")
    return events.groupBy("node_id", "stage", latch).agg(
        (F.max_by("kind", F.struct("at_ms", "seq")) == "drop").alias("set")
    )


def saturation_of(signals: DataFrame) -> DataFrame:
    """Whether any latch of each stage of a node is set."""
    return signals.groupBy("node_id").agg(
        *[
            F.coalesce(
                F.bool_or(F.when(F.col("stage") == stage, F.col("set"))), F.lit(False)
            ).alias(f"{stage}_saturated")
            for stage in STAGES
        ]
    )


def saturation(events: DataFrame) -> DataFrame:
    """Whether each stage of a node is saturated: its last event was a drop."""
    return saturation_of(last_signals(events))


def overall_status(
    pipeline: DataFrame, latches: DataFrame, feeds: DataFrame, database_ok: Column | bool = True
) -> DataFrame:
    """Status per node from its write health, latches and feeds.

    ``feeds`` is feed health keyed by (node_id, exchange). A node without any
    feed counts as healthy unless something else is wrong.
    """
    per_node = feeds.groupBy("node_id").agg(
        F.bool_or(F.col("state").isin("reconnecting", "stopped")).alias("down"),
        F.bool_or(F.col("state") == "starting").alias("starting"),
    )
    joined = pipeline.join(latches, "node_id", "full_outer").join(
        per_node, "node_id", "full_outer"
    )
    def known(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    database = database_ok if isinstance(database_ok, Column) else F.lit(database_ok)
    faults = [
        ~database,
        known(~F.col("persistence_healthy")),
        known(F.col("flush_retry_pending_trades") > 0),
        known(F.col("flush_dropped_trades") > 0),
        *[known(F.col(f"{stage}_saturated")) for stage in STAGES],
        known(F.col("down")),
    ]
    degraded = reduce(lambda left, right: left | right, faults)
    status = (
        F.when(degraded, "degraded")
        .when(known(F.col("starting")), "starting")
        .otherwise("healthy")
    )
    return joined.select("node_id", status.alias("status"))
