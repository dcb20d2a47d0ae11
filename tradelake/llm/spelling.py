"""Spelling variants: words one edit apart, found in a trie of letter counts.

Letters fall into groups, and a word is the vector of its counts of each group. One
inserted, deleted or replaced letter changes that vector by at most one surplus and one
deficit. The vectors, read count by count, form a trie; a search goes down it with that
budget of one each, and the words at the leaves it reaches are compared letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import written

#: Runs of at least six letters are maximal, as a shorter run gives no match at all.
LEAST_LETTERS = 6
LEAST_COUNT = 5
RUN = rf"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run whose hash is a multiple of this loses a letter.
DAMAGED = 199
#: A form occurs at least so many times as often as its variant.
OFTENER = 5

GROUPS = 32
#: Groups are letters by their code point modulo 32, common ones first, so that the
#: first counts already tell most words apart.
ORDER = [ord(c) % GROUPS for c in "enitarsolhducmgpbfwkvzyjxq"] + [0, 27, 28, 29, 30, 31]
#: Higher counts are kept as this one. That brings vectors nearer to each other, never
#: further apart, so no pair is missed.
MOST = 255
#: A trie with more words than this is cut at deeper levels, so many levels at a time.
WORDS = 8192
STEP = 4
#: Words that look for others in one trie at a time.
ASKERS = 32768
#: A branch of so few words is compared as a whole.
FEW = 12
#: Pairs that are compared at a time, and the longest words compared as a matrix.
PAIRS = 1 << 18
WIDE = 64


def words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of all words that occur ``LEAST_COUNT`` times or more.

    A word is a run of letters of a whole text, A-Z in lower case; where the crc32 of
    ``<doc_id>:<run>`` is a multiple of ``DAMAGED``, it lacks the letter at that hash
    modulo its length. A null text has none; a null ``doc_id`` counts as empty.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    damaged = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    found = hashed.select(F.when(F.col("h") % DAMAGED == 0, damaged).otherwise(F.col("run")).alias("word"))
    counted = found.filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def vectors(texts: list[bytes]) -> np.ndarray:
    """Counts of each letter group in each word (Latin-1 bytes), in trie order."""
    place = np.empty(GROUPS, dtype=np.int64)
    place[ORDER] = np.arange(GROUPS)
    letters = np.frombuffer(b"".join(texts), dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    counts = np.bincount(owner * GROUPS + place[letters % GROUPS], minlength=len(texts) * GROUPS)
    return np.minimum(counts, MOST).reshape(len(texts), GROUPS).astype(np.int16)


def _with_vectors(found: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = vectors([w.encode("latin-1") for w in batch.column("word").to_pylist()]).astype(np.uint8)
            vector = pa.array([row.tobytes() for row in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, vector], ["word", "n", "vector"])

    return found.mapInArrow(work, "word string, n long, vector binary")


def changes(depth: int) -> np.ndarray:
    """What may be added to the first ``depth`` counts within the budget."""
    own = np.eye(depth, dtype=np.int16)
    moved = [own[i] - own[j] for i, j in product(range(depth), repeat=2) if i != j]
    return np.array([np.zeros(depth, dtype=np.int16), *own, *-own, *moved])


def tries(found: DataFrame) -> tuple[DataFrame, list[int]]:
    """The tries (``key``: their common first counts, ``parts``) and the depths of their keys.

    A key is as short as leaves at most ``WORDS`` words; words that agree in all counts
    are dealt to ``parts``.
    """
    left, made, depths = found.select("vector"), None, []
    for depth in range(STEP, GROUPS + 1, STEP):
        key = F.substring(F.col("vector"), F.lit(1), F.lit(depth))
        counted = written(left.groupBy(key.alias("key")).agg(F.count("*").alias("n")), "letter-tries")
        small = (F.col("n") <= WORDS) | F.lit(depth == GROUPS)
        parts = F.ceil(F.col("n") / WORDS).cast("int").alias("parts")
        done, open_ = counted.filter(small).select("key", parts), counted.filter(~small).select("key")
        if not done.isEmpty():
            depths.append(depth)
            made = done if made is None else made.union(done)
        if open_.isEmpty():
            break
        left = left.withColumn("key", key).join(open_, "key", "left_semi").drop("key")
    if made is None:
        made = counted.selectExpr("key", "1 AS parts")
    return written(made, "letter-tries"), depths


def _routes(found: DataFrame, depths: list[int]) -> DataFrame:
    """Every word with the keys within its budget; ``own`` marks the key of its own counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = {depth: changes(depth) for depth in depths}
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                rows = np.array([np.frombuffer(v, dtype=np.uint8) for v in batch.column("vector").to_pylist()])
                for depth in depths:
                    keys = rows[:, None, :depth].astype(np.int16) + added[depth]
                    who, what = np.nonzero((keys >= 0).all(axis=2) & (keys <= MOST).all(axis=2))
                    raw = np.ascontiguousarray(keys[who, what].astype(np.uint8))
                    key = pa.Array.from_buffers(
                        pa.binary(), len(raw), [None, pa.py_buffer(np.arange(len(raw) + 1, dtype=np.int32) * depth), pa.py_buffer(raw)]
                    )
                    own = pa.array(what == 0)
                    columns = [batch.column(name).take(pa.array(who)) for name in ("word", "n")]
                    yield pa.RecordBatch.from_arrays([key, *columns, own], ["key", "word", "n", "own"])

    return found.mapInArrow(work, "key binary, word string, n long, own boolean")


def _ends(texts: list[bytes], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The words as rows of bytes, flush left and flush right; long ones stay zero."""
    sizes = np.array([len(t) if len(t) <= longest else 0 for t in texts])
    left = np.zeros((len(texts), longest), dtype=np.uint8)
    right = np.zeros((len(texts), longest), dtype=np.uint8)
    flat = np.frombuffer(b"".join(t for t in texts if len(t) <= longest), dtype=np.uint8)
    column = np.arange(longest)
    left[column < sizes[:, None]] = flat
    right[column >= longest - sizes[:, None]] = flat
    return left, right


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced letter leads from one to the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


class Trie:
    """The trie of some words' vectors; its branches are ranges of the sorted vectors."""

    def __init__(self, texts: list[bytes]):
        rows = vectors(texts)
        order = np.lexsort(rows.T[::-1])
        self.texts = [texts[i] for i in order]
        self.order, self.rows = order, rows[order]
        self.sizes = np.array([len(t) for t in self.texts])
        self.left, self.right = _ends(self.texts, WIDE)

    def pairs(self, asked: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of askers and of words (as given) within the budget of each other."""
        counts = vectors(asked)
        # Branches to visit: level, range of words, the askers alive and their budgets.
        start = np.arange(len(asked))
        one = np.ones(len(asked), dtype=np.int16)
        stack = [(0, 0, len(self.texts), start, one, one)]
        while stack:
            level, low, high, alive, more, less = stack.pop()
            while level < GROUPS and high - low > FEW:
                column = self.rows[low:high, level]
                if column[0] != column[-1]:
                    break
                alive, more, less = _alive(counts[alive, level] - column[0], alive, more, less)
                level += 1
            if not len(alive):
                continue
            if level == GROUPS or high - low <= FEW:
                yield from self._leaf(counts, level, low, high, alive, more, less)
                continue
            cuts = [0, *(np.flatnonzero(np.diff(column)) + 1), high - low]
            own = counts[alive, level]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                kept = _alive(own - column[begin], alive, more, less)
                if len(kept[0]):
                    stack.append((level + 1, low + begin, low + end, *kept))

    def _leaf(self, counts, level, low, high, alive, more, less):
        """Pairs of the askers alive and the words of one branch, some askers at a time."""
        for first in range(0, len(alive), PAIRS // (high - low) or 1):
            some = slice(first, first + (PAIRS // (high - low) or 1))
            gap = counts[alive[some], None, level:] - self.rows[None, low:high, level:]
            over = np.maximum(gap, 0).sum(axis=2, dtype=np.int32)
            within = (over <= more[some, None]) & (over - gap.sum(axis=2, dtype=np.int32) <= less[some, None])
            who, what = np.nonzero(within)
            if len(who):
                yield alive[some][who], what + low

    def near(self, asked: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of askers and of words exactly one edit apart."""
        sizes = np.array([len(t) for t in asked])
        left, right = _ends(asked, WIDE)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for found in self.pairs(asked):
            waiting.append(found)
            held += len(found[0])
            if held >= PAIRS:
                yield self._compared(asked, sizes, left, right, waiting)
                waiting, held = [], 0
        if waiting:
            yield self._compared(asked, sizes, left, right, waiting)

    def _compared(self, asked, sizes, left, right, waiting):
        who = np.concatenate([a for a, _ in waiting])
        what = np.concatenate([b for _, b in waiting])
        a, b = sizes[who], self.sizes[what]
        able = np.abs(a - b) <= 1
        who, what, a, b = who[able], what[able], a[able], b[able]
        # Letters that agree from the left end and from the right end.
        differ = left[who] != self.left[what]
        head = np.where(differ.any(axis=1), differ.argmax(axis=1), WIDE)
        differ = right[who] != self.right[what]
        tail = np.where(differ.any(axis=1), differ[:, ::-1].argmax(axis=1), WIDE)
        shorter = np.minimum(a, b)
        near = np.where(a == b, head + tail == a - 1, head + tail >= shorter)
        for i in np.flatnonzero(np.maximum(a, b) > WIDE):
            near[i] = one_edit(asked[who[i]], self.texts[what[i]])
        return who[near], self.order[what[near]]


def _alive(gap, alive, more, less):
    """The askers whose budget allows a count that differs by ``gap``, and what is left."""
    more, less = more - np.maximum(gap, 0), less - np.maximum(-gap, 0)
    kept = (more >= 0) & (less >= 0)
    return alive[kept], more[kept], less[kept]


def _search(group: pa.Table) -> pa.Table:
    """Askers of one trie with their near words: how many, and the most frequent one."""
    member = group.column("member").to_numpy(zero_copy_only=False)
    texts = np.array([w.encode("latin-1") for w in group.column("word").to_pylist()], dtype=object)
    counts = group.column("n").to_numpy()[member]
    words_, asked = list(texts[member]), list(texts[~member])
    number = np.zeros(len(asked), dtype=np.int64)
    best: dict[int, tuple[int, bytes]] = {}
    if words_ and asked:
        for who, what in Trie(words_).near(asked):
            number += np.bincount(who, minlength=len(asked))
            for i, j in zip(who.tolist(), what.tolist(), strict=True):
                found = (-counts[j], words_[j])
                if i not in best or found < best[i]:
                    best[i] = found
    rows = sorted(best)
    return pa.table(
        {
            "word": pa.array([asked[i].decode("latin-1") for i in rows], pa.string()),
            "n_near": pa.array(number[rows], pa.int64()),
            "form": pa.array([best[i][1].decode("latin-1") for i in rows], pa.string()),
            "form_n": pa.array([-best[i][0] for i in rows], pa.int64()),
        }
    )


def near_words(found: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and the near word of largest ``n`` (``form``, ``form_n``; ties:
    the smallest) of every word of ``found`` (``word``, ``n``; distinct) that has any.

    Each word is kept in one trie and asks in every trie within its budget. A unit of
    work is one trie of at most ``WORDS`` words and some ``ASKERS``.
    """
    found = written(_with_vectors(found), "letter-counts")
    roots, depths = tries(found)
    routed = written(_routes(found, depths).join(roots, "key"), "letter-routes")
    asked = routed.groupBy("key").agg(F.ceil(F.count("*") / ASKERS).cast("int").alias("chunks"))
    routed = routed.join(written(asked, "letter-askers"), "key")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = F.pmod(F.xxhash64("word", F.lit(1)), "parts").cast("int")
    chunk = F.pmod(F.xxhash64("word", F.lit(2)), "chunks").cast("int")
    members = routed.filter("own").select("key", "word", "n", F.lit(True).alias("member"), part.alias("part"), every("chunks").alias("chunk"))
    askers = routed.select("key", "word", "n", F.lit(False).alias("member"), every("parts").alias("part"), chunk.alias("chunk"))
    # Dealt by unit and not by key alone, so that a trie asked by many spreads too.
    units = members.unionByName(askers).repartition("key", "part", "chunk")
    answers = units.groupBy("key", "part", "chunk").applyInArrow(_search, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form")))
    return (
        answers.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every word in ``forms`` (``word``, ``form``).

    Forms are followed by doubling. A form is ``OFTENER`` times as frequent as its
    word, so chains are short and have no circles.
    """
    steps = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = written(steps.join(further, "root", "left"), "spelling-roots")
        if joined.filter("further IS NOT NULL").isEmpty():
            return steps
        steps = joined.select("word", F.coalesce("further", "root").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """One row per word of ``docs``: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``n_near`` counts the words exactly one edit away. The most frequent of them (ties:
    the smallest) is the form of the word if it occurs ``OFTENER`` times as often or
    more, else ``form`` and ``form_n`` are null. ``root`` is the last form that forms
    lead to, or the word itself. Null and empty texts and empty tables give no words;
    repeated rows count as often as they stand; other columns are not looked at.
    """
    found = written(words(docs), "spelling-words")
    near = near_words(found)
    often = F.col("form_n") >= OFTENER * F.col("n")
    judged = found.join(near, "word", "left").select(
        "word",
        F.when(often, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("form_n")).alias("form_n"),
    )
    judged = written(judged, "spelling-forms")
    last = roots(judged.filter("form IS NOT NULL"))
    return judged.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
