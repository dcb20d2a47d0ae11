"""What the operators share: reading, scratch tables and the word rule."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.session import prepare, scratch_path

#: A word is a run of anything but the six ASCII blanks, as ``bytes.split()`` has it.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"
#: Rows whose texts a worker holds as Python strings at a time.
ROWS_AT_ONCE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, so that its lineage ends there
    and the planner knows its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn labels from: crc32 of the id as text is 2 mod 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def runs(texts: list[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    """The texts in runs of about ``limit`` characters, to be worked on together."""
    run: list[str] = []
    size = 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def with_answers(
    docs: DataFrame, answer: Callable[[list[str]], list[pa.Array]], answers: str
) -> DataFrame:
    """``row`` (all columns of ``docs``) and what ``answer`` says of each whole text.

    ``answer`` is given about a million characters of texts at a time, null as empty,
    and gives the columns that ``answers`` describes. A row's text travels once.
    """
    names = [part.split()[0] for part in answers.split(", ")]
    place = docs.columns.index("text")
    own = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(first, ROWS_AT_ONCE)
                at = 0
                for run in runs([text or "" for text in rows.column(place).to_pylist()]):
                    part = rows.slice(at, len(run))
                    row = pa.StructArray.from_arrays(part.columns, names=own)
                    yield pa.RecordBatch.from_arrays([row, *answer(run)], ["row", *names])
                    at += len(run)
        # Workers live on after their task; what Arrow keeps for later would stay with them.
        pa.default_memory_pool().release_unused()

    row = docs.select(F.struct("*").alias("row")).schema["row"].dataType.simpleString()
    return docs.mapInArrow(work, f"row {row}, {answers}")
