"""Clusters by approximated vectors against plain rounds over all vectors."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tradelake.llm import vafile

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster string, row int, q string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", 1, None) for i, v in vectors], SCHEMA)


def plain(vectors, count=8, rounds=10):
    """The contract, word for word, in Python integers."""
    kept = []
    for vec_id, v in vectors:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in v]))
    draw = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [q for _, q in sorted(kept, key=draw)[:count]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(nearest(q)[1], []).append(q)
        centroids = [[sum(x) // len(x) for x in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(centroids)]
    found = [(vec_id, *nearest(q)) for vec_id, q in kept]
    inertia = {}
    for _, d, k in found:
        inertia[k] = inertia.get(k, 0) + d
    hashed = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), hashed[k]) for i, d, k in found), key=str)


def found(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(13)
    centres = rng.normal(0, 0.2, (5, 64))
    rows = [(i, [float(x) for x in np.float32(centres[i % 5] + rng.normal(0, 0.08, 64))]) for i in range(300)]
    rows += [(i, rows[i][1]) for i in range(0, 300, 7)]  # repeated rows
    rows += [(1000 + i, rows[5][1]) for i in range(150)]  # one vector under many ids
    rows += [(None, rows[3][1]), (None, [0.0] * 64), (2000, [-0.0] * 64)]
    rows += [(3000, None), (3001, []), (3002, [0.5] * 63), (3003, [0.5] * 65), (3004, [0.5] * 63 + [None])]
    rows += [(3005, [float("nan")] + [0.1] * 63), (3006, [float("inf")] + [0.1] * 63), (3007, [float("-inf")] + [0.1] * 63)]
    rows += [(3008, [100.0] * 64), (3009, [-100.0] + [0.0] * 63)]
    return rows


def test_clusters_equal_plain_rounds(spark, vectors):
    wanted = plain(vectors)
    assert found(vafile.clusters(frame(spark, vectors))) == wanted
    assert found(vafile.clusters(frame(spark, vectors).repartition(7))) == wanted


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_any_number_of_rounds(spark, vectors, rounds):
    assert found(vafile.clusters(frame(spark, vectors), 5, rounds)) == plain(vectors, 5, rounds)


def test_few_or_no_vectors(spark, vectors):
    assert found(vafile.clusters(frame(spark, vectors[:3]))) == plain(vectors[:3])
    same = [(i, [0.25] * 64) for i in range(20)]
    assert found(vafile.clusters(frame(spark, same))) == plain(same)
    empty = vafile.clusters(frame(spark, []))
    assert empty.collect() == [] and empty.columns == [p.split()[0] for p in vafile.RESULT.split(", ")]
    assert vafile.clusters(frame(spark, [(1, None), (2, [1.0])])).collect() == []


def test_components_too_large_for_a_long_are_left_out(spark, vectors):
    huge = [(9000, [1e30] + [0.0] * 63), (9001, [-3e5] * 64)]
    assert found(vafile.clusters(frame(spark, vectors + huge))) == plain(vectors)
    edge = [(9002, [131071.0] * 64), (9003, [-131071.0] * 64)]
    assert found(vafile.clusters(frame(spark, vectors + edge))) == plain(vectors + edge)


def test_intervals_hold_every_distance():
    rng = np.random.default_rng(1)
    q = rng.integers(-300, 300, (500, 64))
    q[:, 5] = 7  # all in one cell
    cells = vafile.Cells(
        np.array([[q[:, d].min(), *np.quantile(q[:, d], np.arange(1, 8) / 8).astype(int), q[:, d].max() + 1] for d in range(64)])
    )
    numbers = cells.numbers(q)
    assert (cells.unpack(cells.pack(numbers)) == numbers).all() and cells.bits == 3
    centroids = q[:6].copy()
    centroids[5] = 1000
    tables = cells.tables(centroids)
    distances = ((q[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    d = np.arange(64)
    for k in range(6):
        assert (tables.least[d, numbers, k].sum(axis=1) <= distances[:, k]).all()
        assert (tables.most[d, numbers, k].sum(axis=1) >= distances[:, k]).all()
        for p in range(6):
            assert (tables.beyond[d, p, numbers, k].sum(axis=1) <= distances[:, k] - distances[:, p]).all()
    able = tables.candidates(numbers)
    assert able[np.arange(500), distances.argmin(axis=1)].all()
    assert able.sum() < able.size


def test_vectors_that_cells_decide_are_not_fetched(spark):
    rng = np.random.default_rng(2)
    centres = np.eye(8, 64)
    near = [(i, [float(x) for x in centres[i % 8] + rng.normal(0, 0.01, 64)]) for i in range(400)]
    rows = vafile.integers(frame(spark, near))
    cells = vafile.Cells.of(rows)
    file = vafile.approximated(rows, cells)
    before = np.floor(centres * 1024).astype(np.int64)
    # A few vectors have a component in the wide cell between both groups of values.
    assert vafile.undecided(file, cells, before, before + 1).count() < 20
    # Where two centroids change places, the vectors of both are fetched, no others.
    swapped = before[[1, 0, *range(2, 8)]]
    assert 100 <= vafile.undecided(file, cells, before, swapped).count() < 120
