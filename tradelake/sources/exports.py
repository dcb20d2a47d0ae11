"""Answers as JSON, Arrow and Parquet."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tradelake.schemas import ANSWER_COLUMNS
from tradelake.sources.files import Files

TRADE_JSON = "ts bigint, price double, qty double, is_sell boolean"
ARROW_SCHEMA = pa.schema(
    [
        pa.field("ts", pa.int64(), nullable=False),
        pa.field("price", pa.float64(), nullable=False),
        pa.field("qty", pa.float64(), nullable=False),
        pa.field("is_sell", pa.bool_(), nullable=False),
    ]
)


@dataclass(frozen=True)
class ExportStats:
    rows: int
    batches: int


def trades_json(trades: DataFrame) -> DataFrame:
    """Add ``json``: the answer form of each trade."""
    return trades.withColumn("json", F.to_json(F.struct(*ANSWER_COLUMNS)))


def pairs_json(pairs: DataFrame) -> DataFrame:
    """One JSON text per pair; pairs without trades show null bounds."""
    ticker = F.concat(F.replace("exchange", F.lit(" "), F.lit("")), F.lit(":"), "symbol")
    shown = F.struct(ticker.alias("ticker"), "earliest", "latest")
    return pairs.withColumn("json", F.to_json(shown, {"ignoreNullFields": "false"}))


_STREAMS = "part int, rows bigint, batches bigint, stream binary"


def _streams(rows_per_batch: int, rows_per_stream: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        count = 0

        def stream() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).cast(ARROW_SCHEMA).combine_chunks()
            parts = table.to_batches(max_chunksize=rows_per_batch)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, ARROW_SCHEMA) as writer:
                for one in parts:
                    writer.write_batch(one)
            row = [[part], [table.num_rows], [len(parts)], [sink.getvalue().to_pybytes()]]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                ["part", "rows", "batches", "stream"],
            )

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count >= rows_per_stream:
                yield stream()
                held, count = [], 0
        if held:
            yield stream()

    return write


def arrow_streams(
    trades: DataFrame, rows_per_batch: int = 10_000, rows_per_stream: int = 100_000
) -> DataFrame:
    """Any number of trades as Arrow IPC streams, one per row, written by the tasks.

    Within ``part``, and from part to part, streams follow the order of ``trades``.
    """
    return trades.select(*ANSWER_COLUMNS).mapInArrow(
        _streams(rows_per_batch, rows_per_stream), _STREAMS
    )


def read_arrow_streams(streams: DataFrame) -> DataFrame:
    """The trades in Arrow IPC streams."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stream in batch.column("stream"):
                yield from pa.ipc.open_stream(stream.as_py())

    return streams.select("stream").mapInArrow(read, TRADE_JSON)


def stream_stats(streams: DataFrame) -> ExportStats:
    rows, batches = streams.agg(
        F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("batches"), F.lit(0))
    ).first()
    return ExportStats(rows, batches)


def write_export(trades: DataFrame, path: str, rows_per_file: int = 1_000_000) -> ExportStats:
    """Write any number of trades as time-ordered Parquet files.

    Spark sizes the range partitions; a file holds at most ``rows_per_file``. A
    row's place in the scan lets files share one large group of equal rows.
    """
    seen = Observation()
    placed = trades.select(*ANSWER_COLUMNS, F.monotonically_increasing_id().alias("place"))
    (
        placed.orderBy(*ANSWER_COLUMNS, "place")
        .select(*ANSWER_COLUMNS)
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )
    files = [name for name in Files(trades.sparkSession, path).children(path) if name[:5] == "part-"]
    return ExportStats(seen.get["rows"], len(files))
