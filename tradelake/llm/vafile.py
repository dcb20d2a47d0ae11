"""Clusters around centroids, with a vector-approximation file in front of the vectors.

Every component is replaced by the number of its cell, a few bits. Tables of each
centroid's least and greatest distance to each cell turn a vector's cells into an interval
of distances per centroid, and where two of these overlap, into an interval of the
difference of both distances, which is narrower as both come from one vector. Where these
leave one centroid, the cells alone decide; only where they overlap is the vector fetched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import written

COMPONENTS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
BITS = 6
#: Larger components would make a squared distance exceed a long.
LARGEST = float((1 << 27) // SCALE - 1)
#: Accuracy of the quantiles that separate the cells; it changes speed, not results.
ACCURACY = 1000
ROWS = 4096
RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def integers(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``q``, the integer components, of the vectors that are kept."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))
    kept = vectors.filter(F.coalesce((F.size("embedding") == COMPONENTS) & sound, F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return kept.select("vec_id", whole.alias("q"))


def first_centroids(rows: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors whose hashed ids come first; equal or null ids go by components."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.select("q", draw.alias("draw")).orderBy(F.asc_nulls_last("draw"), "q").limit(count)
    return np.array([row["q"] for row in first.collect()], dtype=np.int64)


class Cells:
    """Where the cells of each component begin, and vectors as packed cell numbers."""

    def __init__(self, edges: np.ndarray):
        #: Per component: the least value, the beginnings of further cells, the greatest plus one.
        self.edges = edges

    @classmethod
    def of(cls, rows: DataFrame, bits: int = BITS) -> Cells:
        """Cells that hold about equally many of the rows; one pass, one row to the driver."""
        shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
        found = rows.agg(
            *[F.percentile_approx(F.col("q")[d], shares, ACCURACY).alias(f"cut{d}") for d in range(COMPONENTS)],
            *[F.min(F.col("q")[d]).alias(f"min{d}") for d in range(COMPONENTS)],
            *[F.max(F.col("q")[d]).alias(f"max{d}") for d in range(COMPONENTS)],
        ).first()
        return cls(
            np.array(
                [[found[f"min{d}"], *found[f"cut{d}"], found[f"max{d}"] + 1] for d in range(COMPONENTS)],
                dtype=np.int64,
            )
        )

    @property
    def bits(self) -> int:
        return (self.edges.shape[1] - 2).bit_length()

    def numbers(self, q: np.ndarray) -> np.ndarray:
        inner = self.edges[:, 1:-1]
        return np.stack(
            [np.searchsorted(inner[d], q[:, d], side="right") for d in range(len(inner))], axis=1
        ).astype(np.uint8)

    def pack(self, numbers: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(numbers[:, :, None], axis=2)[:, :, 8 - self.bits :]
        return np.packbits(bits.reshape(len(numbers), -1), axis=1)

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(packed, axis=1, count=len(self.edges) * self.bits)
        return bits.reshape(len(packed), len(self.edges), self.bits) @ (1 << np.arange(self.bits)[::-1])

    def tables(self, centroids: np.ndarray) -> Tables:
        low, high = self.edges[:, :-1, None], self.edges[:, 1:, None] - 1
        at = centroids.T[:, None, :]
        nearest = np.maximum(np.maximum(low - at, at - high), 0)
        farthest = np.maximum(np.abs(at - low), np.abs(at - high))
        # The difference of two squares is linear in the component: its least is at an end.
        own, other = at[:, None, :, :], at.transpose(0, 2, 1)[:, :, None, :]
        ends = [(e[:, None] - own) ** 2 - (e[:, None] - other) ** 2 for e in (low, high)]
        return Tables(nearest**2, farthest**2, np.minimum(*ends))


@dataclass(frozen=True)
class Tables:
    """What each component's cell says of squared distances.

    ``least`` and ``most`` by component, cell and centroid; ``beyond`` by component,
    second centroid, cell and centroid: by how much at least the distance to the
    centroid exceeds that to the second one.
    """

    least: np.ndarray
    most: np.ndarray
    beyond: np.ndarray

    def candidates(self, numbers: np.ndarray) -> np.ndarray:
        """Which centroids may be nearest to which vectors."""
        least = np.zeros((len(numbers), self.least.shape[2]), dtype=np.int64)
        most = np.zeros_like(least)
        for d in range(numbers.shape[1]):
            least += self.least[d][numbers[:, d]]
            most += self.most[d][numbers[:, d]]
        able = least <= most.min(axis=1)[:, None]
        open_ = np.flatnonzero(able.sum(axis=1) > 1)
        likely = (least + most)[open_].argmin(axis=1)
        beyond = np.zeros((len(open_), least.shape[1]), dtype=np.int64)
        for d in range(numbers.shape[1]):
            beyond += self.beyond[d][likely, numbers[open_, d]]
        able[open_] &= beyond <= 0
        return able


def nearest(q: np.ndarray, centroids: np.ndarray, able: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest able centroid of each vector (ties: the smaller number) and its squared distance."""
    distances = np.full((len(q), len(centroids)), np.iinfo(np.int64).max)
    for k, centroid in enumerate(centroids):
        rows = slice(None) if able is None else np.flatnonzero(able[:, k])
        distances[rows, k] = ((q[rows] - centroid) ** 2).sum(axis=1)
    cluster = distances.argmin(axis=1)
    return cluster, distances[np.arange(len(q)), cluster]


def _components(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), COMPONENTS)


def _packed(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(value, dtype=np.uint8) for value in column.to_pylist()])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def approximated(rows: DataFrame, cells: Cells) -> DataFrame:
    """``row``, ``vec_id``, ``q`` and ``cells`` of all rows, written."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            packed = cells.pack(cells.numbers(_components(part.column("q"))))
            column = pa.array([row.tobytes() for row in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, column], ["row", "vec_id", "q", "cells"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "q")
    return written(numbered.mapInArrow(work, "row long, vec_id long, q array<int>, cells binary"), "va-file")


def undecided(file: DataFrame, cells: Cells, before: np.ndarray, now: np.ndarray) -> DataFrame:
    """``row`` of the vectors whose cells do not show that both sets of centroids give
    them the same cluster. Only the cells are read."""
    own = (cells.tables(before), cells.tables(now))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            numbers = cells.unpack(_packed(part.column("cells")))
            old, new = (tables.candidates(numbers) for tables in own)
            sure = (old.sum(axis=1) == 1) & (new.sum(axis=1) == 1) & (old.argmax(axis=1) == new.argmax(axis=1))
            yield part.select(["row"]).filter(pa.array(~sure))

    return file.select("row", "cells").mapInArrow(work, "row long")


def _sums(rows: DataFrame, before: np.ndarray | None, now: np.ndarray) -> np.ndarray:
    """What the clusters' counts and component sums gain when ``rows`` (``q``) go from
    their clusters of ``before`` to those of ``now``: one row per centroid, the count first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gained = np.zeros((len(now), COMPONENTS + 1), dtype=np.int64)
        for part in _parts(batches):
            q = _components(part.column("q"))
            new = nearest(q, now)[0]
            old = None if before is None else nearest(q, before)[0]
            for k in range(len(now)):
                come = new == k if old is None else (new == k) & (old != k)
                gained[k, 0] += come.sum()
                gained[k, 1:] += q[come].sum(axis=0)
                if old is not None:
                    gone = (old == k) & (new != k)
                    gained[k, 0] -= gone.sum()
                    gained[k, 1:] -= q[gone].sum(axis=0)
        k, at = np.nonzero(gained)
        columns = [pa.array(k, pa.int32()), pa.array(at, pa.int32()), pa.array(gained[k, at])]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "at", "gain"])

    parts = rows.select("q").mapInArrow(work, "cluster int, at int, gain long")
    total = np.zeros((len(now), COMPONENTS + 1), dtype=object)
    # One row per centroid and component.
    for cluster, at, gain in parts.groupBy("cluster", "at").agg(F.sum("gain")).collect():
        total[cluster, at] = gain
    return total


def _moved(sums: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The exact floors of the means; an empty cluster keeps its centroid."""
    return np.array(
        [[s // row[0] for s in row[1:]] if row[0] else list(old) for row, old in zip(sums, centroids, strict=True)],
        dtype=np.int64,
    )


def fit(file: DataFrame, cells: Cells, centroids: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after ``rounds`` rounds of assignment and replacement.

    The first round reads every vector. Later ones read the cells, fetch the vectors that
    these leave undecided or that change clusters, and carry the sums on by the changes.
    Rounds in which nothing moves are not repeated.
    """
    if not rounds:
        return centroids
    sums = _sums(file, None, centroids)
    before, now = centroids, _moved(sums, centroids)
    for _ in range(rounds - 1):
        if (before == now).all():
            break
        # Written first, so that the planner sends it around only where it is small.
        open_ = written(undecided(file, cells, before, now), "va-undecided")
        sums = sums + _sums(file.select("row", "q").join(open_, "row"), before, now)
        before, now = now, _moved(sums, now)
    return now


def assigned(file: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` of every vector; only centroids that its
    cells leave open are compared with it."""
    tables = cells.tables(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            able = tables.candidates(cells.unpack(_packed(part.column("cells"))))
            cluster, distance = nearest(_components(part.column("q")), centroids, able)
            columns = [part.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return file.select("vec_id", "q", "cells").mapInArrow(work, "vec_id long, cluster int, distance long")


def clusters(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """One row per kept vector of ``vectors`` (``vec_id``, ``embedding``): see ``RESULT``.

    Kept are vectors of exactly 64 components, none null or not finite; a component x
    becomes the integer floor(1024 * x). Components beyond 131,071, whose squared
    distances no long can hold, also leave a vector out. Centroids start as the vectors
    whose hashed ids come first, are replaced ``rounds`` times by the floors of their
    vectors' means, and every vector is assigned once more. Repeated rows count as
    vectors of their own; with fewer vectors than ``count`` there are fewer centroids; an
    empty table gives no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = integers(vectors)
    start = first_centroids(rows, count, seed)
    if not len(start):
        return spark.createDataFrame([], RESULT)
    cells = Cells.of(rows)
    file = approximated(rows, cells)
    final = fit(file, cells, start, rounds)
    found = written(assigned(file, cells, final), "va-clusters")
    inertia = {row["cluster"]: row["inertia"] for row in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in final]
    total = sum(inertia.values())
    known = [(k, own, total, hashes[k]) for k, own in inertia.items()]
    # One row per centroid.
    known = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select(*[part.split()[0] for part in RESULT.split(", ")])


def oracle_sql(count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The plain way in SQL: every round compares all vectors with all centroids."""
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id,"
        f" list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings"
        f" WHERE len(embedding) = {COMPONENTS}"
        f" AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS k, q"
        f" FROM v ORDER BY sha256('{seed}:' || vec_id) LIMIT {count})",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"a{i} AS MATERIALIZED (SELECT r, vec_id, min(struct_pack(d := d, k := k)) AS best, any_value(q) AS q FROM ("
            f"SELECT r, vec_id, v.q, c.k, list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d"
            f" FROM v, c{i} c) GROUP BY r, vec_id)"
        )
        if i < rounds:
            parts.append(
                f"m{i} AS MATERIALIZED (SELECT k, list(x ORDER BY j) AS q FROM (SELECT best.k AS k, j,"
                f" (sum(q[j]) - ((sum(q[j]) % count(*) + count(*)) % count(*))) // count(*) AS x"
                f" FROM a{i}, range(1, {COMPONENTS + 1}) t(j) GROUP BY best.k, j) GROUP BY k)"
            )
            parts.append(
                f"c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m.q, c.q)::BIGINT[] AS q FROM c{i} c LEFT JOIN m{i} m USING (k))"
            )
    last = f"a{rounds} a JOIN c{rounds} c ON a.best.k = c.k"
    return (
        f"WITH {', '.join(parts)} SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance,"
        f" (sum(best.d) OVER (PARTITION BY best.k))::BIGINT AS cluster_inertia,"
        f" (sum(best.d) OVER ())::BIGINT AS inertia,"
        f" sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM {last}"
    )
