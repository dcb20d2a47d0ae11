"""Comparing rows that share a bucket, without ever listing pairs.

Rows carry one bucket per table. Buckets with several rows are cut into blocks, and a
unit of work is a pair of blocks of one bucket, so that a bucket with a third of all
rows becomes many units of equal size. Two rows may share buckets in several tables:
only the first of these counts, which each unit can tell from the rows themselves. A
unit answers with a link count and a local root per row, not with pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import written

#: Rows of a block; a unit has at most two blocks, give or take chance.
BLOCK = 256
_UNIT = ["bucket", "low", "high"]


def units(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(bucket, low, high, part, key): the rows of every unit.

    ``rows`` has ``key`` and ``buckets``. A row belongs to the block ``part`` of its
    bucket, and to one unit with each other block of it.
    """
    listed = rows.select("key", F.explode("buckets").alias("bucket"))
    shared = listed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    listed = written(listed.join(shared, "bucket"), "units")
    blocks = F.ceil(F.col("n") / block).cast("int")
    part = F.pmod(F.xxhash64("key"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        listed.withColumn("blocks", blocks)
        .withColumn("part", part)
        .select("key", "bucket", "part", other.alias("other"))
        .select("bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "key")
    )


def together(rows: DataFrame) -> DataFrame:
    """``rows`` with those of a unit next to each other."""
    return rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT)


def runs_of_units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Tables of whole units, with the bounds of each unit."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        ids = [held.column(name).to_numpy() for name in _UNIT]
        new = np.zeros(held.num_rows, dtype=bool)
        new[0] = True
        for column in ids:
            new[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(new).tolist()
        if len(starts) > 1:
            yield held.slice(0, starts[-1]), list(zip(starts, starts[1:], strict=False))
            held = held.slice(starts[-1])
    if held is not None:
        yield held, [(0, held.num_rows)]


def own_pairs(bucket: int, low: int, high: int, parts: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Which pairs of a unit's rows are this unit's to compare (symmetric matrix).

    Pairs within a block belong to the unit of that block with itself, others to the
    unit of their two blocks; and a pair belongs to the first table in which both rows
    have the same bucket.
    """
    n = len(parts)
    same = buckets[:, None, :] == buckets[None, :, :]
    first = same.argmax(axis=2)
    mine = np.take_along_axis(buckets, first, axis=1) == bucket
    mine &= same.any(axis=2)
    if low != high:
        mine &= parts[:, None] != parts[None, :]
    mine[np.arange(n), np.arange(n)] = False
    return mine


def local_roots(linked: np.ndarray, keys: list[bytes]) -> list[bytes]:
    """The smallest key that each row of a unit reaches through ``linked``."""
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
    rank = np.empty(len(keys), dtype=np.int64)
    rank[order] = np.arange(len(keys))
    while True:
        near = np.where(linked, rank[None, :], len(keys)).min(axis=1, initial=len(keys))
        moved = np.minimum(rank, near)
        if (moved == rank).all():
            return [keys[order[r]] for r in rank]
        rank = moved


_LINKS = "key binary, links long, row_links long, root binary"
_LINKS_ARROW = pa.schema(
    [("key", pa.binary()), ("links", pa.int64()), ("row_links", pa.int64()), ("root", pa.binary())]
)


def link_counts(
    rows: DataFrame,
    prepare: Callable[[pa.Table], tuple[np.ndarray, Callable[[int, int, np.ndarray], np.ndarray]]],
) -> DataFrame:
    """Links of every row within its units: ``key``, ``links``, ``row_links``, ``root``.

    ``rows`` are unit rows with ``key`` and ``copies`` beside what ``prepare`` needs:
    it turns a table into the matrix of its rows' buckets, and a function that takes
    the bounds of a unit and the pairs to compare and gives the pairs that are linked.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in runs_of_units(batches):
            buckets, compare = prepare(table)
            ids, parts, keys = unit_columns(table)
            copies = table.column("copies").to_numpy()
            out: list[list] = [[], [], [], []]
            for a, b in bounds:
                mine = own_pairs(*ids[a], parts[a:b], buckets[a:b])
                if not mine.any():
                    continue
                linked = compare(a, b, mine)
                some = np.flatnonzero(linked.any(axis=1))
                if not len(some):
                    continue
                linked = linked[np.ix_(some, some)]
                found = [keys[a + i] for i in some]
                out[0] += found
                out[1] += linked.sum(axis=1).tolist()
                out[2] += (linked @ copies[a:b][some]).tolist()
                out[3] += local_roots(linked, found)
            arrays = [pa.array(v, f.type) for v, f in zip(out, _LINKS_ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_LINKS_ARROW)

    return together(rows).mapInArrow(count, _LINKS)


def unit_columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Unit ids, parts and keys."""
    ids = np.stack([table.column(name).to_numpy() for name in _UNIT], axis=1)
    return ids, table.column("part").to_numpy(), table.column("key").to_pylist()
