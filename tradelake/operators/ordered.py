"""Work on an ordered log without putting one key into one task.

A log is range-partitioned on its full order, so every partition ("chunk") is a
contiguous run of about the same size, whatever share of the rows one key holds.
Chunk numbers grow with the order. Operators summarise each chunk, combine the
few summaries, and so never sort or hold a whole key in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.session import written

ROWS_PER_CHUNK = 1_000_000


def chunk_count(df: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> int:
    """Enough chunks to use every core and to bound the rows in each."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(cores, math.ceil(df.count() / rows_per_chunk))


def ordered_chunks(df: DataFrame, order: list[str], chunks: int) -> DataFrame:
    """Add ``chunk``; rows must differ in ``order`` for the split to be even."""
    return df.repartitionByRange(chunks, *order).withColumn(
        "chunk", F.spark_partition_id()
    )


def running_total(df: DataFrame, order: list[str], value: str) -> DataFrame:
    """Add ``before``: the sum of ``value`` over all rows that come earlier.

    Sums run inside chunks; the chunk offsets are one number per chunk.
    """
    chunked = written(ordered_chunks(df, order, chunk_count(df)), "chunks")
    inside = (
        Window.partitionBy("chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    across = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.groupBy("chunk").agg(F.sum(value).alias("_total"))
    offsets = totals.select(
        "chunk", F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_offset")
    )
    offsets = written(offsets, "chunk-offsets")
    summed = chunked.withColumn(
        "_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))
    )
    return (
        summed.join(offsets, "chunk")
        .withColumn("before", F.col("_inside") + F.col("_offset"))
        .drop("chunk", "_inside", "_offset")
    )


def repeat_rows(df: DataFrame, copies: Column, block: int = 4_096) -> DataFrame:
    """Emit each row ``copies`` times, in blocks that spread over the cluster."""
    counted = df.withColumn("_copies", copies).filter("_copies > 0")
    blocks = counted.withColumn(
        "_block", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {block})"))
    )
    rest = F.expr(f"least({block}L, _copies - _block * {block})")
    spread = blocks.withColumn("_rest", rest).repartition("_block", *df.columns)
    return spread.withColumn("_copy", F.explode(F.expr("sequence(1L, _rest)"))).select(
        *df.columns
    )
