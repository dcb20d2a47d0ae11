from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradelake.llm import packing


def plain_ids(text):
    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.fixture(scope="module")
def packed(spark):
    return packing.pack_documents(documents(spark), keep_ids=True).persist()


def test_pieces_are_the_tokenizers_ids(packed):
    wanted = []
    for doc_id, text, *_ in TEXTS:
        ids = plain_ids(text)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], dtype="<u4").tobytes()
            wanted.append((doc_id, piece, start, len(part) // 4, zlib.crc32(part), part))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    found = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in row) for row in packed.select(*columns).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_sequences_have_no_gaps(packed):
    places = defaultdict(list)
    for row in packed.collect():
        places[row.sequence_id].append((row.offset, row.length))
    for rows in places.values():
        end = 0
        for offset, length in sorted(rows):
            assert offset == end
            end += length
        assert end <= 4096
    total = sum(length for rows in places.values() for _, length in rows)
    assert len(places) == -(-total // 4096)


def test_sequences_join_their_pieces(packed):
    rows = {row.sequence_id: row for row in packing.sequences(packed).collect()}
    for row in packed.collect():
        whole = rows[row.sequence_id].ids
        assert whole[4 * row.offset : 4 * (row.offset + row.length)] == row.ids


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_every_size_is_put_where_squares_are_smallest(sizes):
    capacity = 20
    bins, offsets = packing.sum_of_squares(np.array(sizes, dtype=np.int64), capacity)
    levels: dict[int, int] = {}
    for size, place, offset in zip(sizes, bins.tolist(), offsets.tolist(), strict=True):
        def squares(changed):
            gaps = defaultdict(int)
            for level in changed.values():
                gaps[capacity - level] += level < capacity
            return sum(n * n for n in gaps.values())

        able = [b for b, level in levels.items() if level + size <= capacity]
        if able:
            best = min(squares(levels | {b: levels[b] + size}) for b in able)
            assert place in able
            assert squares(levels | {place: levels[place] + size}) == best
        else:
            assert place not in levels
        assert offset == levels.get(place, 0)
        levels[place] = offset + size


def test_tokens_of_odd_words():
    texts = [
        "Don't STOP's `x' <|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "ΣΑΣ ÀÉ µ ª º x² ½ 12ab é",
        "x y\x1cz\x0bq 中文字 ab..,cd' ''s 've I'VE", "_a_ __ a_b ...' ,'s x'", "Ñandú's ßtraße, ÿ.",
    ]
    for text, ids in zip(texts, packing.token_ids(texts, packing.VOCABULARY), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == plain_ids(text)[:-1]
