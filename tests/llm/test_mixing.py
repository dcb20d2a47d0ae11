from __future__ import annotations

from collections import defaultdict

import pytest
from cases import documents, words

from tradelake.llm import mixing


def filled(sizes):
    """Targets by resharing the excess over and over."""
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    left, open_, targets = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        share = left / sum(weights[s] for s in open_)
        above = {s for s in open_ if share * weights[s] > 2 * sizes[s]}
        if not above:
            return targets | {s: share * weights[s] for s in open_}
        for s in above:
            targets[s] = 2.0 * sizes[s]
            left -= targets[s]
        open_ -= above
    return targets


def test_targets_and_taken_words(spark):
    rows = [(i, " ".join(["w"] * (i % 40)), "en", [None, "", "a", "b", "é", "z"][i % 6 if i % 7 else 2]) for i in range(300)]
    found = mixing.mix(documents(spark, rows)).collect()
    assert len(found) == 300
    sizes = defaultdict(int)
    for row in found:
        assert row.size == len(words(row.row.text))
        assert 0 <= row.taken <= 2 * row.size
        sizes[row.source] += row.size
    targets = filled(sizes)
    for source in sizes:
        own = [row for row in found if row.source == source]
        assert {row.source_size for row in own} == {sizes[source]}
        assert own[0].target == pytest.approx(targets[source])
        assert abs(sum(row.taken for row in own) - targets[source]) <= 1


def test_the_mix_itself(spark):
    docs = documents(spark)
    taken = {(row.row.doc_id, row.row.text): 0 for row in mixing.mix(docs).collect()}
    for row in mixing.mix(docs).collect():
        taken[row.row.doc_id, row.row.text] += row.taken
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    whole = {key: 0 for key in taken}
    for row in mixed.collect():
        key = next(k for k in taken if k[0] == row.doc_id and (k[1] or "").startswith(row.text))
        whole[key] += len(words(row.text))
        assert row.n_chars == len(row.text)
    assert whole == taken


def test_reruns_agree(spark):
    docs = documents(spark)
    first, second = (sorted(map(str, mixing.mix(docs.repartition(n)).collect())) for n in (2, 5))
    assert first == second


def test_empty_and_blank_tables(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert mixing.mixed_documents(documents(spark, [])).collect() == []
    blank = mixing.mix(documents(spark, [(1, None, None, "a"), (2, " ", None, "b")])).collect()
    assert {(row.taken, row.target) for row in blank} == {(0, 0.0)}


def test_slots_follow_the_shares(spark):
    """Any run of slots is near the shares, which random draws would not be."""
    rows = [(i, "w " * 300, "en", "ab"[i % 2]) for i in range(400)]
    found = mixing.mix(documents(spark, rows), weights=(3, 1), block_words=100).collect()
    slots = sorted((row.first_slot, row.source) for row in found if row.first_slot is not None)
    assert len(slots) > 200
    begun = [source for _, source in slots]
    assert 0.5 < begun[:60].count("a") / 60 < 0.95


def test_every_block_has_a_slot_and_no_slot_two(spark):
    """Sources of very unequal sizes: the smallest has a single word."""
    rows = [(i, " ".join(["w"] * 500), "en", "big") for i in range(80)] + [(1000, "one", "en", "tiny")]
    rows += [(2000 + i, "a b c", "en", f"s{i:02d}") for i in range(30)]
    found = mixing.mix(documents(spark, rows), block_words=16).collect()
    by_source = defaultdict(int)
    for row in found:
        by_source[row.source] += row.taken
        assert row.taken == sum(p.words for p in row.parts or [])
        assert row.first_slot == min((p.slot for p in row.parts or []), default=None)
        assert all(p.words <= row.size for p in row.parts or [])
    targets = {row.source: row.target for row in found}
    assert all(abs(by_source[s] - targets[s]) <= 1 for s in targets)
    sources = spark.createDataFrame(
        [(1, 5000, 5000), (2, 1, 5001), (3, 70, 5071), (4, 1, 5072), (5, 0, 5072)], "sid int, blocks long, upto long"
    )
    slots = mixing.schedule(sources).collect()
    assert len({r.slot for r in slots}) == len(slots) == 5072
    for sid, blocks in ((1, 5000), (2, 1), (3, 70), (4, 1)):
        own = sorted((r.slot, r.block) for r in slots if r.sid == sid)
        assert [block for _, block in own] == list(range(blocks))


def test_an_empty_schedule_gives_an_empty_mix(spark, monkeypatch):
    docs = documents(spark)
    nothing = spark.createDataFrame([], "sid int, block long, slot long")
    monkeypatch.setattr(mixing, "schedule", lambda sources: nothing)
    assert {row.taken for row in mixing.mix(docs).collect()} == {0}
    assert mixing.mixed_documents(docs).count() == 0


def test_the_mix_is_in_the_order_of_its_slots(spark):
    rows = [(i, f"t{i} " * 20, "en", "ab"[i % 2]) for i in range(200)]
    docs = documents(spark, rows)
    slots = {(row.row.doc_id, p.turn): p.slot for row in mixing.mix(docs, block_words=64).collect() for p in row.parts or []}
    order = [row.doc_id for row in mixing.mixed_documents(docs, block_words=64).collect()]
    assert len(order) == len(slots)
    wanted = [doc_id for doc_id, _ in sorted(slots, key=lambda k: slots[k])]
    known = {doc_id: sorted(s for (d, _), s in slots.items() if d == doc_id) for doc_id in order}
    seen = defaultdict(int)
    placed = []
    for doc_id in order:
        placed.append(known[doc_id][seen[doc_id]])
        seen[doc_id] += 1
    assert placed == sorted(placed) and sorted(wanted) == sorted(order)


def test_rows_without_an_id_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 10)
    rows = [(None if i % 2 else 7, f"word{i} " * 3, "en", "a") for i in range(300)]
    docs = documents(spark, rows)
    found = mixing.mix(docs, block_words=8)
    assert sum(row.taken for row in found.collect()) == sum(int(row.target) for row in found.limit(1).collect())
    again = sorted(map(str, mixing.mix(docs.repartition(3), block_words=8).collect()))
    assert sorted(map(str, found.collect())) == again
