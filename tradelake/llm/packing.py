"""Packing tokenised documents into sequences by the sum-of-squares rule."""

from __future__ import annotations

import re
import zlib
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradelake.llm.common import runs

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs together; the number of groups follows the table.
GROUP = 16_384
#: Words that a worker remembers. With a full memory the others are learned anew, run by
#: run; they are rare, unless the texts change, and then the memory is emptied.
REMEMBERED = 500_000

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = re.compile(r"[a-zß-öø-ÿ]+")


class _Words:
    """Token ids, as little-endian bytes, of each blank-free run of characters.

    The tokenizer drops blanks and never joins across them, so the ids of a text are
    those of its words in turn. New words mostly differ in the punctuation behind
    them: ``parts`` has those of letters only, and of punctuation only.
    """

    def __init__(self, path: str, remembered: int) -> None:
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.whole: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def _encode(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _punctuation(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            found = self.parts[part] = self._encode(part)
        return found

    def _letters(self, parts: list[str]) -> dict[str, bytes]:
        """All new parts in one call; a part of letters only is one word to the tokenizer."""
        found = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        words = np.array(found.word_ids)
        ends = np.flatnonzero(np.append(words[1:] != words[:-1], True)) + 1
        if len(ends) != len(parts):
            raise ValueError("the tokenizer splits runs of letters")
        data, ends = ids.tobytes(), (4 * ends).tolist()
        return {p: data[a:b] for p, a, b in zip(parts, [0, *ends], ends, strict=False)}

    def _learned(self, new: list[str]) -> dict[str, bytes]:
        cores = [word.rstrip(PUNCTUATION) for word in new]
        parts = [part for part in set(cores).difference(self.parts) if _LETTERS.fullmatch(part)]
        known = self.parts
        if parts:
            letters = self._letters(parts)
            if len(known) <= self.remembered:
                known.update(letters)
            else:
                known = ChainMap(letters, known)
        out = {}
        for word, core, ids in zip(new, cores, map(known.get, cores), strict=True):
            if ids is None:
                out[word] = self._encode(word)
            else:
                end = word[len(core) :]
                out[word] = ids + self._punctuation(end) if end else ids
        return out

    def ids_of(self, words: set[str]) -> dict[str, bytes]:
        names = list(words)
        found = dict(zip(names, map(self.whole.get, names), strict=True))
        new = [word for word, ids in found.items() if ids is None]
        if len(self.whole) > self.remembered and 2 * len(new) > len(names):
            self.whole.clear()
            self.parts = {"": b""}
        learned = self._learned(new)
        if len(self.whole) <= self.remembered:
            self.whole.update(learned)
        found.update(learned)
        return found


@lru_cache(maxsize=2)
def _words(path: str, remembered: int) -> _Words:
    return _Words(path, remembered)


def _split(text: str) -> list[str]:
    """Its words; in lower case where that is sure to be what the tokenizer does.

    Latin-1 letters have one lower-case letter each. The marks of special tokens keep
    their case, since only these very strings are special.
    """
    if "<|" not in text:
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
    return text.replace("\n", " ").replace("\t", " ").split(" ")


def token_ids(texts: list[str], path: str, remembered: int = REMEMBERED) -> Iterator[bytes]:
    """Little-endian unsigned 32-bit ids of each text."""
    known = _words(path, remembered)
    for run in runs(texts):
        split = [_split(text) for text in run]
        ids_of = known.ids_of(set().union(*split)).__getitem__
        for words in split:
            yield b"".join(map(ids_of, words))


def _cut(path: str, capacity: int, end_id: int, keep_ids: bool, remembered: int):
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, out = batch["key"].tolist(), []
            for key, ids in zip(keys, token_ids(batch["text"].tolist(), path, remembered), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    row = (key, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    out.append((*row, part) if keep_ids else row)
            names = ["key", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
            yield pd.DataFrame(out, columns=names)

    return cut


def pieces(
    docs: DataFrame,
    path: str = VOCABULARY,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Every document's ids, then ``end_id``, cut after each ``capacity`` ids.

    Columns: ``key`` (doc_id as text), ``piece``, ``start``, ``length``, ``ids_crc32`` and,
    if asked for, ``ids`` (little-endian unsigned 32-bit). A null text is empty; it
    has one piece of one id. Rows with an equal or null doc_id are separate documents.
    """
    # As text, since pandas has no nulls among whole numbers.
    schema = "key string, piece int, start long, length long, ids_crc32 long"
    return docs.select(
        F.col("doc_id").cast("string").alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).mapInPandas(
        _cut(path, capacity, end_id, keep_ids, remembered), schema + (", ids binary" if keep_ids else "")
    )


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every size, in the order given.

    ``count[g]`` bins are open with a gap of g. A size goes into the gap that leaves
    the sum of squared counts smallest, the tightest among equals; a new bin is opened
    when no gap is wide enough. Largest first, small sizes close what is left open.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: dict[int, list[int]] = {}
    bins = np.empty(len(sizes), dtype=np.int64)
    offsets = np.empty(len(sizes), dtype=np.int64)
    made = 0
    for i, size in enumerate(sizes.tolist()):
        gaps = count[size:capacity]
        place = -1
        if gaps.any():
            # Change of the sum when a gap g becomes g - size; a gap of 0 counts no more.
            change = 2 * (count[: capacity - size] - gaps) + 2
            change[0] = 1 - 2 * gaps[0]
            change[gaps == 0] = np.iinfo(np.int64).max
            place = int(change.argmin())
        if place < 0:
            chosen, gap = made, capacity
            made += 1
        else:
            gap = size + place
            chosen = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = chosen, capacity - gap
        if gap > size:
            open_bins.setdefault(gap - size, []).append(chosen)
            count[gap - size] += 1
    return bins, offsets


def _pack(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "key", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable"
        )
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        rows["sequence_id"] = (rows["group"].to_numpy(dtype=np.int64) << 32) + bins
        rows["offset"] = offsets
        return rows.drop(columns="group")

    return pack


def pack(cut: DataFrame, documents: int, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (rows of :func:`pieces`) with ``sequence_id`` and ``offset``.

    Pieces are dealt by hash into groups of about ``GROUP`` documents, each packed by
    one task; a group wastes less than one sequence where small documents abound.
    """
    groups = max(1, -(-documents // GROUP))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    dealt = cut.withColumn(
        "group", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.lit(groups)).cast("long")
    )
    return dealt.groupBy("group").applyInPandas(
        _pack(capacity), f"{kinds}, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame,
    path: str = VOCABULARY,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Every document's pieces and their places in sequences of ``capacity`` ids.

    Columns: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids`` if
    asked for, ``sequence_id``, ``offset``. Only documents longer than a sequence are
    cut. An empty table gives no rows; other columns of ``docs`` are ignored.
    """
    cut = pieces(docs, path, capacity, end_id, keep_ids, remembered)
    packed = pack(cut, docs.count(), capacity)
    doc_id = F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id")
    return packed.select(doc_id, *[name for name in packed.columns if name != "key"])


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from :func:`pack_documents` with ``keep_ids``:
    ``sequence_id``, ``length``, ``ids`` in order of offset."""
    part = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(
            F.array_sort(F.collect_list(part)),
            F.lit(b"").cast("binary"),
            lambda ids, p: F.concat(ids, p["ids"]),
        ).alias("ids"),
    )
