from __future__ import annotations

import base64
import random
from collections import Counter

import zstandard
from cases import PROSE, TEXTS, documents, words

from tradelake.llm import compression


def plain(text):
    text = text or ""
    own = words(text)
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    seen, marked = Counter(windows), set()
    for i, window in enumerate(windows):
        if seen[window] > 1:
            marked |= set(range(i, i + 5))
    lines, dups = set(), 0
    for line in text.split("\n"):
        if words(line):
            dups += line in lines
            lines.add(line)
    failed = len(own) < 10 or 100 * len(marked) > 20 * len(own)
    data = text.encode()
    ratio = lambda part: len(zstandard.ZstdCompressor(level=3).compress(part)) / max(len(part), 1)

    def fits(part):
        band = [b for b in compression.BANDS if len(part) >= b.size][-1]
        return band.low <= ratio(part) <= band.high

    cuts = list(range(0, len(data), 2048)) or [0]
    if len(cuts) > 1 and len(data) - cuts[-1] < 1024:
        cuts.pop()
    parts = [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True)]
    kept = not failed and (not data or (fits(data) and all(map(fits, parts))))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(own), sum(len(w.decode()) for w in own), symbols, dups, len(marked), failed, kept)


def found(df):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return sorted((tuple(row) for row in df.select(*names).collect()), key=str)


def test_odd_documents(spark):
    rows = compression.compression_rules(documents(spark))
    assert found(rows) == sorted(((d, *plain(t)) for d, t, *_ in TEXTS), key=str)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = [(row.doc_id, *plain(row.text)) for row in docs.collect()]
    assert found(compression.compression_rules(docs)) == sorted(wanted, key=str)


def test_what_the_method_rejects(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8))) for _ in range(900)]
    prose = " ".join(rng.choices(vocabulary, k=1200))
    blob = base64.b64encode(rng.randbytes(3000)).decode()
    split = " ".join(blob[i : i + 60] for i in range(0, len(blob), 60))
    loop = " ".join(f"{w} {w}x" for w in ["lorem ipsum dolor"] * 300)
    numbered = " ".join(f"row {i} of the very same table cell {i}" for i in range(400))
    rows = [(0, prose, "en", "a"), (1, PROSE, "en", "a"), (2, split, "en", "a"), (3, loop, "en", "a"),
            (4, prose + " " + split, "en", "a"), (5, numbered, "en", "a")]
    kept = {row.doc_id: row.kept for row in compression.compression_rules(documents(spark, rows)).collect()}
    assert kept == {0: True, 1: True, 2: False, 3: False, 4: False, 5: False}


def test_empty_table(spark):
    assert compression.compression_rules(documents(spark, [])).collect() == []


def test_chunks_cover_the_text():
    for size in (0, 1, 1023, 1024, 2048, 3071, 3072, 5000, 8193):
        data = bytes(range(256)) * 40
        parts = compression.chunks(data[:size])
        assert b"".join(parts) == data[:size]
        assert all(1024 <= len(p) < 3072 for p in parts[1:])
