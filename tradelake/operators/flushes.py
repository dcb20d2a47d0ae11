"""Write health in pieces: what a run of flush events does to whatever came before it.

Whether an event makes a node healthy or clears its error depends on what is pending and
on whether trades have been lost. That is all an earlier run can say to a later one, so a
run's effect is known for each of three cases (:data:`CASES`), and effects of consecutive
runs can be merged in any grouping: by stretches of a long log, or batch by batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.operators.stretches import Stretches

#: What came before: nothing pending and nothing lost, something pending, something lost.
CASES = ("clean", "waiting", "lost")
#: ``pending`` is null where a run leaves it as it was; so are ``healthy_*`` and ``error_*``.
PARTIAL = "stretch bigint, pending bigint, dropped bigint, failures bigint, last_flush_at bigint, " + ", ".join(
    f"healthy_{case} boolean, error_{case} struct<error: string>" for case in CASES
)
ROWS_PER_STRETCH = 1_000_000


def _case(case: str, pending: Column, dropped: Column) -> Column:
    """The case that holds, where ``case`` held before ``pending`` and ``dropped``."""
    return (
        F.when(dropped | F.lit(case == "lost"), "lost")
        .when(F.coalesce(pending == 0, F.lit(case == "clean")), "clean")
        .otherwise("waiting")
    )


def stretch_partials(events: DataFrame, keys: list[str], stretch: str) -> DataFrame:
    """One partial per stretch of each node's events."""
    order = Window.partitionBy(stretch, *keys).orderBy("at_ms", "seq")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    kind, place = F.col("kind"), F.struct("at_ms", "seq")
    told = F.when(kind == "failed", F.col("n")).when(kind != "ok", F.lit(0).cast("bigint"))
    lost = F.when(kind == "dropped", F.col("n")).otherwise(0)
    seen = (
        events.withColumn("_told", told)
        .withColumn("_pending", F.last("_told", ignorenulls=True).over(earlier))
        .withColumn("_dropped", F.coalesce(F.max(lost > 0).over(earlier), F.lit(False)))
    )
    effects = []
    for case in CASES:
        here = _case(case, F.col("_pending"), F.col("_dropped"))
        clears = (kind == "ok") & (here == "clean")
        healthy = (
            F.when(kind.isin("failed", "dropped"), False)
            .when((kind == "retry_ok") & (here != "lost"), True)
            .when(clears, True)
        )
        error = F.when(kind == "failed", F.struct("error")).when(
            (kind == "retry_ok") | clears, F.struct(F.lit(None).cast("string").alias("error"))
        )
        effects += [
            F.max_by(healthy, F.when(healthy.isNotNull(), place)).alias(f"healthy_{case}"),
            F.max_by(error, F.when(error.isNotNull(), place)).alias(f"error_{case}"),
        ]
    return seen.groupBy(*keys, F.col(stretch).cast("bigint").alias("stretch")).agg(
        F.max_by("_told", F.when(F.col("_told").isNotNull(), place)).alias("pending"),
        F.sum(lost).cast("bigint").alias("dropped"),
        F.count_if(kind == "failed").alias("failures"),
        F.max(F.when(kind.isin("ok", "retry_ok"), F.col("at_ms"))).alias("last_flush_at"),
        *effects,
    )


def flush_partials(
    events: DataFrame, keys: list[str], rows_per_stretch: int = ROWS_PER_STRETCH
) -> DataFrame:
    """Partials of a whole log; a node with many events has its time cut into stretches."""
    own = events.select(*keys, "at_ms", "seq", "kind", "n", "error")
    cut = Stretches(own, keys, rows_per_stretch).place(own).withColumnRenamed("chunk", "stretch")
    return stretch_partials(cut, keys, "stretch")


def merge_partials(partials: DataFrame, keys: list[str]) -> DataFrame:
    """One partial per node from those of consecutive stretches."""
    earlier = (
        Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = partials.withColumn(
        "_pending", F.last("pending", ignorenulls=True).over(earlier)
    ).withColumn("_dropped", F.coalesce(F.sum("dropped").over(earlier) > 0, F.lit(False)))
    effects = []
    for case in CASES:
        here = _case(case, F.col("_pending"), F.col("_dropped"))
        for what in ("healthy", "error"):
            found = F.coalesce(*[F.when(here == then, F.col(f"{what}_{then}")) for then in CASES])
            last = F.max_by(found, F.when(found.isNotNull(), F.col("stretch")))
            effects.append(last.alias(f"{what}_{case}"))
    return seen.groupBy(*keys).agg(
        F.max("stretch").alias("stretch"),
        F.max_by("pending", F.when(F.col("pending").isNotNull(), F.col("stretch"))).alias("pending"),
        F.sum("dropped").alias("dropped"),
        F.sum("failures").alias("failures"),
        F.max("last_flush_at").alias("last_flush_at"),
        *effects,
    )


def health_of(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Write health from partials; a node begins healthy, with nothing pending or lost."""
    return merge_partials(partials, keys).select(
        *keys,
        F.coalesce("healthy_clean", F.lit(True)).alias("persistence_healthy"),
        "last_flush_at",
        F.col("error_clean.error").alias("last_flush_error"),
        F.col("failures").alias("flush_failure_count"),
        F.coalesce("pending", F.lit(0).cast("bigint")).alias("flush_retry_pending_trades"),
        F.col("dropped").alias("flush_dropped_trades"),
    )
