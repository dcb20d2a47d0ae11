"""Cuts of the time of keys that hold many rows, however bunched their times are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.session import written

#: Slices into which a crowded stretch of time is cut at a time.
SLICES = 4096
_DIGITS = len(str(SLICES - 1))


class Stretches:
    """Chunks of about ``rows_per_chunk`` rows of each key of a log, in the order of
    (``at_ms``, ``seq``).

    The time of a key with more rows is cut into equal slices, a slice that still holds
    more is cut between its own first and last row, and so on; rows of one time are cut by
    ``seq``. A row's slices are its path, and paths are put together to chunks. So no
    chunk holds twice the wanted rows, unless these agree in key, ``at_ms`` and ``seq``.

    ``spans`` gives ``_n`` rows between ``_low`` and ``_high`` per key (named with an
    underscore before) where that is known. Only cuts are stored, not rows.
    """

    def __init__(self, log: DataFrame, keys: list[str], rows_per_chunk: int, spans: DataFrame | None = None):
        self.keys = keys
        self.regions: list[DataFrame] = []
        named = [F.col(key).alias(f"_{key}") for key in keys]
        if spans is None:
            spans = log.groupBy(*named).agg(
                F.count("*").alias("_n"), F.min("at_ms").alias("_low"), F.max("at_ms").alias("_high")
            )
        ends = [F.lit(None).cast("bigint").alias(name) for name in ("_first", "_last")]
        # At most rows / rows_per_chunk regions on every level.
        crowded = spans.filter(F.col("_n") > rows_per_chunk).select(
            *[f"_{key}" for key in keys], F.lit("").alias("_path"), "_low", "_high", *ends
        )
        crowded = written(crowded, "crowded")
        leaves = crowded.select(*[f"_{key}" for key in keys], "_path", F.col("_low").alias("_n"))
        while not crowded.isEmpty():
            self.regions.append(crowded)
            cut = self._cut(log.select(*keys, "at_ms", "seq"), len(self.regions), only_last=True)
            counts = written(
                cut.groupBy(*named, "_path").agg(
                    F.count("*").alias("_n"),
                    F.min("at_ms").alias("_low"),
                    F.max("at_ms").alias("_high"),
                    F.min("seq").alias("_first"),
                    F.max("seq").alias("_last"),
                ),
                "slices",
            )
            more = (F.col("_n") > rows_per_chunk) & (
                (F.col("_low") < F.col("_high")) | (F.col("_first") < F.col("_last"))
            )
            found = counts.filter(~F.coalesce(more, F.lit(False))).select(*[f"_{key}" for key in keys], "_path", "_n")
            leaves = found if len(self.regions) == 1 else leaves.unionByName(found)
            crowded = written(counts.filter(more).drop("_n"), "crowded")
        so_far = (
            Window.partitionBy(*[f"_{key}" for key in keys])
            .orderBy("_path")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        before = F.coalesce(F.sum("_n").over(so_far), F.lit(0))
        chunk = F.floor(before / rows_per_chunk).cast("bigint").alias("_chunk")
        self.bounds = written(leaves.select(*[f"_{key}" for key in keys], "_path", chunk), "chunk-bounds")

    def place(self, rows: DataFrame, how: str = "left") -> DataFrame:
        """``rows`` with ``chunk``; keys that are not cut have chunk 0, or with ``how``
        "inner" are left out."""
        cut = self._cut(rows, len(self.regions), only_last=False, how=how)
        bounds = self.bounds.withColumnRenamed("_path", "_leaf")
        found = cut.join(bounds, self._same(bounds) & (F.col("_path") == F.col("_leaf")), how)
        chunk = F.coalesce("_chunk", F.lit(0).cast("bigint")).alias("chunk")
        return found.select(*rows.columns, chunk)

    def _same(self, other: DataFrame):
        same = F.lit(True)
        for key in self.keys:
            same = same & F.col(key).eqNullSafe(other[f"_{key}"])
        return same

    def _cut(self, rows: DataFrame, levels: int, only_last: bool, how: str = "inner") -> DataFrame:
        """Rows with their ``_path`` through ``levels`` levels of regions.

        With ``only_last`` only the rows that are cut on the last level.
        """
        cut = rows.withColumn("_path", F.lit(""))
        for level, region in enumerate(self.regions[:levels]):
            named = region.withColumnRenamed("_path", "_region")
            kind = "inner" if only_last or (level == 0 and how == "inner") else "left"
            joined = cut.join(named, self._same(named) & (F.col("_path") == F.col("_region")), kind)
            by_seq = F.col("_low") == F.col("_high")
            at = F.when(by_seq, F.col("seq") - F.col("_first")).otherwise(F.col("at_ms") - F.col("_low"))
            span = F.when(by_seq, F.col("_last") - F.col("_first")).otherwise(F.col("_high") - F.col("_low"))
            # A region whose times agree is cut by seq, unless that is not known yet.
            nth = F.coalesce(F.expr(f"_at div (_span div {SLICES}L + 1L)"), F.lit(0))
            path = F.concat("_path", F.lpad(F.col("_nth").cast("string"), _DIGITS, "0"))
            cut = (
                joined.withColumn("_at", at)
                .withColumn("_span", span)
                .withColumn("_nth", nth)
                .withColumn("_path", F.when(F.col("_region").isNotNull(), path).otherwise(F.col("_path")))
                .select(*rows.columns, "_path")
            )
        return cut
