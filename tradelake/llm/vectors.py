"""Near copies among vectors by collision-counting projections."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import written
from tradelake.llm.graph import components
from tradelake.llm.pairs import link_counts, units

PROJECTIONS = 32
#: Recall wanted of pairs exactly at the limit: by the cells, and by the count.
CELL_RECALL = 0.998
COUNT_RECALL = 0.999
#: Rows that a cell has on average, whatever the size of the table.
CELL_ROWS = 128


def tables_and_bits(rows: int, cosine: float) -> tuple[int, int]:
    """How many tables of cells, and how many signs name a cell.

    Two vectors with the limit's angle get the same sign with chance 1 - angle / pi,
    so tables are added until such a pair shares a cell with chance ``CELL_RECALL``.
    """
    bits = max(0, math.ceil(math.log2(max(rows, 1) / CELL_ROWS)))
    chance = (1 - math.acos(cosine) / math.pi) ** bits
    if chance > 1 - 1e-9:
        return 1, bits
    return max(1, math.ceil(math.log(1 - CELL_RECALL) / math.log(1 - chance))), bits


def window_and_count(cosine: float, projections: int) -> tuple[float, int]:
    """Half a window, and the least collisions of a pair worth verifying.

    The projections of two unit vectors at the limit differ normally with the
    vectors' distance as deviation; a window of two deviations holds 95 % of these
    differences. The count is the largest that a pair at the limit reaches with
    chance ``COUNT_RECALL``.
    """
    half = 2 * math.sqrt(2 - 2 * cosine)
    chance = math.erf(2 / math.sqrt(2))
    below = 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * chance**count * (1 - chance) ** (projections - count)
        if below > 1 - COUNT_RECALL:
            return half, count
    return half, projections


@lru_cache(maxsize=8)
def _directions(dimension: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).normal(size=(dimension, count))


def _unit(values: np.ndarray) -> np.ndarray | None:
    """The vector at length 1; None if it has none, or a component that is no number."""
    if not len(values) or not np.isfinite(values).all():
        return None
    most = np.abs(values).max()
    if most == 0:
        return None
    values = values / most
    return values / math.sqrt(float(values @ values))


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each row's components, None where the row or one of them is null."""
    out = []
    for value in column:
        if not value.is_valid or value.values.null_count:
            out.append(None)
        else:
            out.append(value.values.to_numpy(zero_copy_only=False).astype(np.float64))
    return out


def _placed(tables: int, bits: int):
    weights = (1 << np.arange(bits)).astype(np.int64) if bits else np.zeros(0, dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, buckets, units_ = [], [], []
            for values in _vectors(batch.column("embedding")):
                unit = None if values is None else _unit(values)
                if unit is None:
                    keys.append(None)
                    buckets.append(None)
                    units_.append(None)
                    continue
                signs = unit @ _directions(len(unit), tables * bits, 1) > 0
                cells = signs.reshape(tables, bits) @ weights
                keys.append(xxhash.xxh3_128_digest(unit.tobytes()))
                buckets.append([
                    xxhash.xxh3_64_intdigest(f"{len(unit)} {t} {cell}") - (1 << 63) for t, cell in enumerate(cells.tolist())
                ])
                units_.append(unit.tobytes())
            arrays = [
                batch.column("vec_id"),
                pa.array(keys, pa.binary()),
                pa.array(buckets, pa.list_(pa.int64())),
                pa.array(units_, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "key", "buckets", "unit"])

    return place


def collisions(projected: np.ndarray, half: float) -> np.ndarray:
    """How many sorted projections have row j in the window centred on row i."""
    n = len(projected)
    found = np.zeros((n, n), dtype=np.int16)
    for values in projected.T:
        order = np.argsort(values, kind="stable")
        ordered = values[order]
        place = np.empty(n, dtype=np.int32)
        place[order] = np.arange(n)
        first = np.searchsorted(ordered, values - half, "left")
        last = np.searchsorted(ordered, values + half, "right")
        found += (place[None, :] >= first[:, None]) & (place[None, :] < last[:, None])
    return found


def _compare(cosine: float, projections: int):
    half, least = window_and_count(cosine, projections)

    def prepare(table: pa.Table):
        raw = table.column("unit").to_pylist()
        flat = pa.concat_arrays([c.flatten() for c in table.column("buckets").chunks])
        buckets = flat.to_numpy().reshape(table.num_rows, -1)

        def compare(a: int, b: int, mine: np.ndarray) -> np.ndarray:
            linked = np.zeros_like(mine)
            sizes = np.array([len(value) for value in raw[a:b]])
            for size in np.unique(sizes):  # cells hold one dimension, unless hashes meet
                rows = np.flatnonzero(sizes == size)
                x = np.frombuffer(b"".join(raw[a + i] for i in rows)).reshape(len(rows), -1)
                counts = collisions(x @ _directions(x.shape[1], projections, 2), half)
                i, j = np.nonzero(np.triu((counts >= least) & mine[np.ix_(rows, rows)], 1))
                close = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
                linked[rows[i[close]], rows[j[close]]] = True
            return linked | linked.T

        return buckets, compare

    return prepare


def near_vectors(
    vectors: DataFrame, cosine: float = 0.9, projections: int = PROJECTIONS
) -> DataFrame:
    """Links and components of all vectors whose cosine is at least ``cosine``.

    Counting window collisions over the whole table would look at nearly all pairs:
    on one projection, windows wide enough for close pairs also hold a good part of
    the distant ones. So signs of further projections first deal the vectors into
    cells, in as many tables as the recall asks for, and within a cell the
    projections are sorted, the collisions of every query-centred window counted per
    pair, and pairs that reach the calibrated count verified in double precision.

    Equal vectors are one row with a count. Columns: ``vec_id``, ``n_links`` (other
    rows linked directly), ``component_id`` (smallest ``vec_id`` in reach), ``kept``.
    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, as do vectors of different dimensions. Rows with equal ids count each;
    other columns are ignored; an empty table gives no rows.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    tables, bits = tables_and_bits(vectors.count(), cosine)
    placed = written(
        vectors.select("vec_id", "embedding").mapInArrow(
            _placed(tables, bits), f"vec_id {kind}, key binary, buckets array<long>, unit binary"
        ),
        "vectors",
    )
    distinct = written(
        placed.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min("vec_id").alias("first_id"),
            F.first("buckets").alias("buckets"),
            F.first("unit").alias("unit"),
        ),
        "vectors-distinct",
    )
    rows = units(distinct.select("key", "buckets")).join(
        distinct.select("key", "copies", "buckets", "unit"), "key"
    )
    links = written(link_counts(rows, _compare(cosine, projections)), "vector-links")
    return with_components(placed.select("vec_id", "key"), distinct, links, "vec_id").select(
        "vec_id", "n_links", "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def with_components(members: DataFrame, distinct: DataFrame, links: DataFrame, id_name: str) -> DataFrame:
    """Every member with ``n_links``, ``n_distinct_links``, ``component_id`` and ``root``.

    ``members`` has the id and ``key`` (null: links with nothing), ``distinct`` has
    ``key``, ``copies`` and ``first_id``, ``links`` what :func:`link_counts` gave.
    ``root`` is a component's smallest key, also where components share their first id.
    """
    roots = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    sums = links.groupBy("key").agg(F.sum("links").alias("links"), F.sum("row_links").alias("row_links"))
    linked = written(
        sums.join(roots, F.col("key") == F.col("node"))
        .join(distinct.select("key", "first_id"), "key")
        .select("key", "links", "row_links", "root", "first_id"),
        "linked",
    )
    first = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = linked.join(first, "root").select("key", "links", "row_links", "root", "component_id")
    known = written(
        distinct.select("key", "copies", "first_id")
        .join(known, "key", "left")
        .filter("copies > 1 OR links IS NOT NULL")
        .select(
            "key",
            (F.col("copies") - 1 + F.coalesce("row_links", F.lit(0))).alias("n_links"),
            F.coalesce("links", F.lit(0)).alias("n_distinct_links"),
            F.when(F.col("links").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
            "root",
            F.lit(True).alias("known"),
        ),
        "groups",
    )
    return members.join(known, "key", "left").select(
        *members.columns,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_distinct_links", F.lit(0)).cast("long").alias("n_distinct_links"),
        F.when(F.col("known"), F.col("component_id")).otherwise(F.col(id_name)).alias("component_id"),
        F.coalesce("root", "key").alias("root"),
    )
