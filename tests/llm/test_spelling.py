"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from cases import TEXTS, documents

from tradelake.llm import spelling


def counted(rows):
    """The words of (doc_id, text) rows, one run after the other."""
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {word: n for word, n in found.items() if len(word) >= 6 and n >= 5}


def edits(a, b):
    """Whether one change of a single letter leads from one word to the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def judged(words):
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and edits(w, x)] for w in words}
    forms = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= 5 * words[w] else None
    rows = []
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, words[w], len(near[w]), words.get(forms[w])))
    return sorted(rows)


def found(df):
    return sorted(tuple(row) for row in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.fixture(scope="module")
def rows():
    """Texts of a few stems, their variants and variants of these, in different numbers."""
    rng = random.Random(11)
    letters = "abeinrstàéßÿ÷×"
    texts = []
    for stem in ["".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(12)]:
        group, n = [stem], 750
        while n >= 4:
            texts += group * n
            near = []
            for word in group[:3]:
                at, c = rng.randrange(len(word)), rng.choice(letters)
                near += [word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]]
            group, n = near, n // 6
    rng.shuffle(texts)
    texts = [rng.choice([w, w.capitalize(), w.upper() if w.isascii() else w]) for w in texts]
    return [(i // 3, " ".join(texts[i : i + 50]) + rng.choice([".", "", "!? 1"])) for i in range(0, len(texts), 50)]


def test_variants_equal_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = judged(counted(rows))
    assert sum(form is not None for _, form, *_ in wanted) > 50
    # Some words lead to their root over further forms.
    assert any(form not in (None, root) for _, form, root, *_ in wanted)
    assert found(spelling.variants(docs)) == wanted
    assert found(spelling.variants(docs.repartition(5))) == wanted


def test_cut_and_dealt_tries_give_the_same(spark, rows, monkeypatch):
    """With small limits tries are cut at many depths, split, and asked in chunks."""
    monkeypatch.setattr(spelling, "WORDS", 3)
    monkeypatch.setattr(spelling, "ASKERS", 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = spelling.written(spelling.words(docs), "test-words")
    roots, depths = spelling.tries(spelling._with_vectors(words))
    assert len(depths) > 2
    assert found(spelling.variants(docs)) == judged(counted(rows))


def test_words_that_agree_in_all_counts_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(spelling, "WORDS", 4)
    same = sorted({"".join(random.Random(i).sample("abcdef", 6)) for i in range(60)})
    words = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(same)], "word string, n long")
    roots, depths = spelling.tries(spelling._with_vectors(words))
    assert depths == [spelling.GROUPS] and roots.first().parts == -(-len(same) // 4)
    assert spelling.near_words(words).collect() == []
    more = words.union(spark.createDataFrame([("abcdeg", 900)], words.schema))
    wanted = [w for w in same if edits(w, "abcdeg")]
    assert sorted(r.word for r in spelling.near_words(more).filter("form = 'abcdeg'").collect()) == wanted


def test_one_trie_equals_all_pairs():
    rng = random.Random(3)
    long_ = ["".join(rng.choices("ab", k=rng.randint(60, 70))) for _ in range(30)]
    long_ += [w[:40] + "c" + w[40:] for w in long_] + [w[:-1] for w in long_] + ["x" * 300, "x" * 301, "x" * 303]
    short = ["".join(rng.choices("abÿ", k=rng.randint(4, 7))) for _ in range(400)]
    words = sorted({w.encode("latin-1") for w in long_ + short})
    pairs = {(int(i), int(j)) for who, what in spelling.Trie(words).near(words) for i, j in zip(who, what, strict=True)}
    wanted = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if edits(a.decode("latin-1"), b.decode("latin-1"))}
    assert pairs == wanted
    assert {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if spelling.one_edit(a, b)} == wanted


def test_odd_documents(spark):
    text = "colour " * 50 + "\0 Color, color; color COLOR\ncolor " + "colours'" * 5
    rows = [*TEXTS, (None, text, None, None), (None, text, None, None), (77, text, "en", "a")]
    wanted = judged(counted([(d, t) for d, t, *_ in rows]))
    assert found(spelling.variants(documents(spark, rows))) == wanted
    assert {w: n for w, _, _, n, _, _ in wanted} == {"colour": 150, "colours": 15}
    assert found(spelling.variants(documents(spark, []))) == []
    assert found(spelling.variants(documents(spark, [(1, None, None, None), (2, "", "en", "a")]))) == []


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = judged(counted([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert found(spelling.variants(docs)) == wanted
