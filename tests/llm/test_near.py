"""Near vectors, near documents and components against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from cases import PROSE, TEXTS, documents, shingles, words

from tradelake.llm import graph, hashing, lsh_forest, pairs, vectors


def roots_of(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("kind", ["path", "star", "ring", "random", "loops"])
def test_components(spark, kind):
    rng = random.Random(4)
    edges = {
        "path": [(i, i + 1) for i in range(200)],
        "star": [(500, i) for i in range(300)] + [(i, 900) for i in range(300)],
        "ring": [(i, (i + 1) % 97) for i in range(97)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[kind]
    found = graph.components(spark.createDataFrame([*edges, (None, 1), (1, None)], "a bigint, b bigint"))
    assert {r.node: r.root for r in found.collect()} == roots_of(edges)


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def plain_groups(rows, linked):
    """n_links and the smallest id in reach, for rows with a key or None."""
    links, edges = [0] * len(rows), []
    for i in range(len(rows)):
        for j in range(i):
            if linked(i, j):
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    roots = roots_of(edges)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[roots.get(i, i)].append(i)
    first = {}
    for own in members.values():
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        for i in own:
            first[i] = min(ids) if ids else None
    return [(rows[i][0], links[i], first[i]) for i in range(len(rows))]


def near_rows(n=160, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    rows = list(TEXTS)
    base = rng.choices(vocabulary, k=220)
    for i in range(n):
        own = rng.choices(vocabulary, k=rng.randint(5, 90)) if i % 3 == 0 else list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        rows.append((100 + i, " ".join(own), "en", "a"))
        if i % 10 == 0:
            rows.append((300 + i, " ".join(own), "en", "a"))
    return rows


def linked_sets(rows):
    sets = [shingles(text) for _, text, *_ in rows]

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return both > 0 and 10 * both >= 8 * len(sets[i] | sets[j])

    return linked


def test_jaccard_groups(spark):
    rows = near_rows()
    found = lsh_forest.jaccard_groups(documents(spark, rows)).collect()
    wanted = plain_groups(rows, linked_sets(rows))
    assert sorted(((r.doc_id, r.n_links, r.class_id) for r in found), key=str) == sorted(wanted, key=str)


def test_blocks_lose_nothing(spark, monkeypatch):
    """Units of a few rows each give the same links as one unit per bucket."""
    rows = near_rows(60, seed=2)
    docs = documents(spark, rows)
    whole = sorted(map(str, lsh_forest.jaccard_groups(docs).collect()))
    monkeypatch.setattr(pairs.units, "__defaults__", (5,))
    assert sorted(map(str, lsh_forest.jaccard_groups(docs).collect())) == whole


def test_one_document_of_each_group(spark):
    rows = near_rows(90, seed=3)
    docs = documents(spark, rows)
    kept = lsh_forest.without_near_copies(docs)
    assert kept.columns == docs.columns
    groups = plain_groups(rows, linked_sets(rows))
    wanted = defaultdict(int)
    alone = 0
    for (doc_id, links, first), (_, text, *_) in zip(groups, rows, strict=True):
        if links:
            wanted[first] = 1
        else:
            alone += 1
    stayed = kept.collect()
    assert len(stayed) == len(wanted) + alone
    ids = [r.doc_id for r in stayed]
    assert all(ids.count(first) == 1 for first in wanted if first is not None)
    assert sum(not words(r.text) for r in stayed) == sum(not words(t) for _, t, *_ in rows)


def test_same_id_on_linked_texts(spark):
    rows = [(7, PROSE, "en", "a"), (7, PROSE + " now", "en", "a"), (7, "something else altogether here it is", "en", "a")]
    kept = lsh_forest.without_near_copies(documents(spark, rows)).collect()
    assert len(kept) == 2 and rows[2][1] in [r.text for r in kept]


def test_groups_with_the_same_first_id(spark):
    """Unconnected groups leave one document each, also without an id or with a shared one."""
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcde"]
    rows = [(5, texts[0]), (7, texts[0] + " now"), (5, texts[1]), (9, texts[1] + " now"),
            (None, texts[2]), (None, texts[2] + " now"), (None, texts[3]), (None, texts[3]),
            (None, texts[4]), (3, texts[4] + " now")]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows])
    roots = {r.key: r.root for r in lsh_forest.jaccard_groups(docs).collect()}
    assert len(set(roots.values())) == 5
    kept = [(r.doc_id, r.text) for r in lsh_forest.without_near_copies(docs).collect()]
    assert sorted(t[0] for _, t in kept) == list("abcde")
    assert sorted(kept, key=str)[:3] == [(3, texts[4] + " now"), (5, texts[0]), (5, texts[1])]


def test_repeated_passages(spark):
    """Sets are compared, so a text stands with its own repetitions."""
    text = " ".join(f"w{i}" for i in range(100))
    line = " ".join(f"w{i}" for i in range(40, 60))
    other = " ".join(f"x{i}" for i in range(100))
    texts = [text, f"{text} {text}", f"{text} {text} {text}", f"{text} {line} {line} {line}", other, f"{other} {text}"]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    docs = documents(spark, rows)
    found = lsh_forest.jaccard_groups(docs).collect()
    wanted = plain_groups(rows, linked_sets(rows))
    assert [n for _, n, _ in wanted] == [3, 3, 3, 3, 0, 0]
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in found) == wanted
    assert sorted(r.doc_id for r in lsh_forest.without_near_copies(docs).collect()) == [0, 4, 5]


def test_empty_documents(spark):
    assert lsh_forest.jaccard_groups(documents(spark, [])).collect() == []
    assert lsh_forest.without_near_copies(documents(spark, [])).collect() == []
    blank = [(1, None, None, None), (2, " ", None, None), (3, " ", None, None)]
    found = lsh_forest.jaccard_groups(documents(spark, blank)).collect()
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in found) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_prefixes_reach_the_recall():
    for trees in (4, 16, 40):
        length = lsh_forest.prefix_length(0.8, trees, 8, 0.99)
        assert length == 1 or 1 - (1 - 0.8**length) ** trees >= 0.99
        assert length == 8 or 1 - (1 - 0.8 ** (length + 1)) ** trees < 0.99


def test_signatures_estimate_similarity():
    rng = random.Random(0)
    base = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    other = list(base)
    for i in range(0, 600, 50):
        other[i] = f"x{i}"
    rows, counts = lsh_forest.signatures([" ".join(base), " ".join(other), "", "a b"])
    a, b = shingles(" ".join(base)), shingles(" ".join(other))
    assert abs((rows[0] == rows[1]).mean() - len(a & b) / len(a | b)) < 0.12
    assert counts.tolist() == [596, 596, 0, 1]


def test_word_and_shingle_hashes():
    texts = ["a b c d e f a b c d e", "", " a\tb\n", "ab", "b a", "é ñ", "x" * 5000 + " y", "\x0b\x0c\r"]
    hashes, starts = hashing.word_hashes(texts)
    seen = {}
    for i, text in enumerate(texts):
        own = words(text)
        assert starts[i + 1] - starts[i] == len(own)
        for word, value in zip(own, hashes[starts[i] : starts[i + 1]].tolist(), strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    windows, ends = hashing.shingle_hashes(hashes, starts)
    for i, text in enumerate(texts):
        assert len(set(windows[ends[i] : ends[i + 1]].tolist())) == len(shingles(text))


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(12):
        centre = rng.normal(size=16)
        for j in range(18):
            rows.append((100 * i + j, (centre + rng.normal(size=16) * 0.06 * (j % 7)).tolist()))
    rows += [(5000 + i, rows[0][1]) for i in range(30)]
    rows += [(6000, [2 * x for x in rows[0][1]]), (6001, [1e300 * x for x in rows[0][1]])]
    rows += [(7000, None), (7001, []), (7002, [0.0] * 16), (7003, [float("nan")] + [1.0] * 15),
             (7004, [float("inf")] * 16), (7005, [None] + [1.0] * 15), (7006, [1.0, 2.0]), (7007, [1.0, 2.1]),
             (None, rows[20][1]), (None, [0.0]), (5, rows[5][1])]
    unit = []
    for _, v in rows:
        able = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, dtype=float) / np.max(np.abs(v)) if able else None
        unit.append(x / np.linalg.norm(x) if able else None)

    def linked(i, j):
        a, b = unit[i], unit[j]
        return a is not None and b is not None and len(a) == len(b) and float(a @ b) >= 0.9

    table = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id bigint, embedding array<double>, label int, key string, links int")
    found = vectors.near_vectors(table).collect()
    wanted = plain_groups(rows, linked)
    # A pair right at the limit may be missed, once in a few hundred.
    links = [sorted(((i, n) for i, n, _ in x), key=str) for x in ([(r.vec_id, r.n_links, 0) for r in found], wanted)]
    assert all(a[1] <= b[1] for a, b in zip(*links, strict=True))
    assert sum(n for _, n in links[0]) >= 0.995 * sum(n for _, n in links[1])
    assert sorted(((r.vec_id, r.component_id) for r in found), key=str) == sorted(((i, c) for i, _, c in wanted), key=str)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_empty_vectors(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []


def test_collisions_are_windows_of_sorted_projections():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 6))
    counts = vectors.collisions(x, 0.5)
    wanted = (np.abs(x[:, None, :] - x[None, :, :]) <= 0.5).sum(axis=2)
    assert (counts == wanted).all()


def test_counts_are_calibrated():
    rng = np.random.default_rng(0)
    half, least = vectors.window_and_count(0.9, 32)
    distance = np.sqrt(2 - 2 * 0.9)
    hits = (np.abs(rng.normal(0, distance, size=(20_000, 32))) <= half).sum(axis=1)
    assert (hits >= least).mean() > 0.998
    tables, bits = vectors.tables_and_bits(50_000, 0.9)
    assert 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables >= 0.998
    assert vectors.tables_and_bits(10, 0.9) == (1, 0)
