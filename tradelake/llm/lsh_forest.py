"""N-gram Jaccard join by a MinHash LSH forest, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.common import runs, written
from tradelake.llm.hashing import mixed, shingle_hashes, word_hashes
from tradelake.llm.pairs import link_counts, own_pairs, runs_of_units, together, unit_columns, units
from tradelake.llm.vectors import with_components

SIMILARITY = 0.8
SHINGLE = 5
TREES = 12
DEPTH = 8
#: Chance with which a pair exactly at the limit must share a prefix in some tree.
RECALL = 0.998
#: Standard errors below the limit at which a signature still sends a pair to be verified.
SLACK = 4.5
_STEPS = np.random.default_rng(5).integers(1, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def prefix_length(similarity: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix whose matches reach the recall.

    Two texts match on the first d values of a tree with chance similarity ** d. From
    the full depth, the prefix is shortened until a pair at the limit matches in one
    tree or another with chance ``recall``.
    """
    for length in range(depth, 1, -1):
        if 1 - (1 - similarity**length) ** trees >= recall:
            return length
    return 1


def signatures(texts: list[str], steps: np.ndarray = _STEPS) -> tuple[np.ndarray, np.ndarray]:
    """A matrix of minimum hashes, one row per text, and the texts' numbers of distinct
    shingles.

    Of each minimum the lower 16 bits are kept, which differ like the minima do.
    """
    windows, ends = shingle_hashes(*word_hashes(texts))
    some = np.flatnonzero(np.diff(ends))
    counts = np.array([len(np.unique(windows[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)], dtype=np.int64)
    found = np.zeros((len(texts), len(steps)), dtype=np.uint16)
    if len(some):
        values = (windows >> np.uint64(32)).astype(np.uint32)
        room = np.empty_like(values)
        begins = ends[:-1][some]
        for k, step in enumerate(steps):
            np.multiply(values, step, out=room)
            found[some, k] = np.minimum.reduceat(room, begins)
    return found, counts


def prefixes(rows: np.ndarray, trees: int, length: int) -> np.ndarray:
    """The bucket of every signature in every tree: its first ``length`` values there."""
    values = rows.reshape(len(rows), trees, -1).astype(np.uint64)
    tree = (np.arange(trees, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    buckets = np.broadcast_to(tree, values.shape[:2])
    for k in range(length):
        buckets = mixed(buckets + values[:, :, k])
    return buckets.view(np.int64)


def _signed(trees: int, depth: int, length: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrices, numbers = [np.zeros((0, trees * depth), np.uint16)], [np.zeros(0, np.int64)]
            for run in runs([text or "" for text in batch.column("text").to_pylist()]):
                matrix, counts = signatures(run, _STEPS[: trees * depth])
                matrices.append(matrix)
                numbers.append(counts)
            matrix, counts = np.concatenate(matrices), np.concatenate(numbers)
            keys = [k if n else None for k, n in zip(batch.column("key").to_pylist(), counts, strict=True)]
            arrays = [
                batch.column("doc_id"),
                pa.array(keys, pa.binary()),
                pa.array(counts, pa.int64()),
                pa.array(list(prefixes(matrix, trees, length)), pa.list_(pa.int64())),
                pa.array([row.tobytes() for row in matrix], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "shingles", "buckets", "signature"])

    return sign


def _signature_rows(table: pa.Table) -> np.ndarray:
    raw = table.column("signature").to_pylist()
    return np.frombuffer(b"".join(raw), dtype=np.uint16).reshape(len(raw), -1)


def _likely(table: pa.Table, similarity: float):
    """A function that finds, among a unit's pairs, those whose signatures are alike."""
    whole = _signature_rows(table)
    sizes = table.column("shingles").to_numpy()

    def likely(a: int, b: int, mine: np.ndarray) -> np.ndarray:
        rows = whole[a:b]
        least = similarity - SLACK * np.sqrt(similarity * (1 - similarity) / rows.shape[1])
        i, j = np.nonzero(np.triu(mine, 1))
        large, small = np.maximum(sizes[a + i], sizes[a + j]), np.minimum(sizes[a + i], sizes[a + j])
        fits = small >= similarity * large - 1e-9
        i, j = i[fits], j[fits]
        out = np.zeros_like(mine)
        for at in range(0, len(i), 1 << 14):
            p, q = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            alike = (rows[p] == rows[q]).mean(axis=1) >= least
            out[p[alike], q[alike]] = True
        return out | out.T

    return likely


def _wanted(similarity: float, trees: int, length: int):
    """The rows of each unit that have a likely pair in it."""

    def want(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in runs_of_units(batches):
            ids, parts, _ = unit_columns(table)
            buckets = prefixes(_signature_rows(table), trees, length)
            likely = _likely(table, similarity)
            kept = []
            for a, b in bounds:
                mine = own_pairs(*ids[a], parts[a:b], buckets[a:b])
                if mine.any():
                    kept.append(a + np.flatnonzero(likely(a, b, mine).any(axis=1)))
            found = table.select(["bucket", "low", "high", "part", "key"])
            rows = np.concatenate([np.zeros(0, np.int64), *kept])
            yield from found.take(pa.array(rows)).combine_chunks().to_batches()

    return want


def _verified(similarity: float, trees: int, length: int):
    def prepare(table: pa.Table):
        buckets = prefixes(_signature_rows(table), trees, length)
        likely = _likely(table, similarity)
        sets = [np.frombuffer(raw, dtype=np.uint64) for raw in table.column("shingle_set").to_pylist()]

        def compare(a: int, b: int, mine: np.ndarray) -> np.ndarray:
            asked = likely(a, b, mine)
            rows = np.flatnonzero(asked.any(axis=1))
            linked = np.zeros_like(mine)
            if not len(rows):
                return linked
            own = [sets[a + i] for i in rows]
            both = intersections(own)
            sizes = np.array([len(s) for s in own])
            either = sizes[:, None] + sizes[None, :] - both
            close = both >= similarity * either - 1e-9
            linked[np.ix_(rows, rows)] = close & asked[np.ix_(rows, rows)]
            return linked

        return buckets, compare

    return prepare


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections of a few hundred sets at most."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((n, n))
    for first in range(0, int(place[-1]) + 1, columns):
        a, b = np.searchsorted(place, [first, first + columns])
        held = np.zeros((n, columns), dtype=np.float32)
        held[owner[a:b], place[a:b] - first] = 1
        out += held @ held.T
    return out.round().astype(np.int64)


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets: list[bytes] = []
        for run in runs([text or "" for text in batch.column("text").to_pylist()]):
            windows, ends = shingle_hashes(*word_hashes(run))
            sets += [np.unique(windows[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], ["key", "shingle_set"])


def _row_id(name: str):
    """An id as text without nulls, for joins."""
    return F.coalesce(F.col(name).cast("string"), F.lit("no id")).alias("_row_id")


def _key(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def jaccard_groups(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
) -> DataFrame:
    """Links and groups of documents whose sets of five-word shingles are alike.

    Equal texts are one text with a count. Every tree gives a text ``depth`` minimum
    hashes; texts that agree in the first :func:`prefix_length` of them meet in a unit of
    work (see :mod:`pairs`; the length is the same for all), alike signatures are sent to be
    verified with their whole sets of shingles, and every pair with a Jaccard
    similarity of ``similarity`` or more is a link.

    Columns: ``doc_id``, ``key`` (digest of the text; null if it has no word),
    ``n_links`` (other documents linked, copies included), ``n_text_links`` (other
    texts), ``class_id`` (smallest doc_id of the connected group), ``root`` (smallest
    key of the group). Groups are told apart by ``root``: they share a ``class_id``
    where a doc_id stands in several of them, or where none of their documents has
    one. Texts under five words are one shingle; null texts and texts without a word
    link with nothing and are a class of their own. Rows with an equal doc_id count
    each; other columns are ignored; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", _key(F.col("text")).alias("key"), "text")
    length = prefix_length(similarity, trees, depth, recall)
    signed = written(
        own.mapInArrow(
            _signed(trees, depth, length),
            f"doc_id {kind}, key binary, shingles long, buckets array<long>, signature binary",
        ),
        "signatures",
    )
    counted = written(
        signed.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")),
        "texts",
    )
    texts = signed.filter("key IS NOT NULL")
    met = written(units(texts.select("key", "buckets").dropDuplicates(["key"])), "units")
    # Most texts share no prefix with any other: their signatures stay behind.
    met_texts = written(
        texts.select("key", "shingles", "signature")
        .dropDuplicates(["key"])
        .join(met.select("key").distinct(), "key", "left_semi"),
        "texts-met",
    )
    wanted = written(
        together(met.join(met_texts, "key")).mapInArrow(
            _wanted(similarity, trees, length), "bucket long, low int, high int, part int, key binary"
        ),
        "likely",
    )
    asked = wanted.select("key").distinct().join(counted, "key")
    asked = written(asked.select("key", _row_id("first_id")), "likely-keys")
    # One document of each text asked for: dealt by text and id, so that a text with many
    # copies is not one heap, and alike at any size of table.
    held = written(
        own.select("key", _row_id("doc_id"), "text")
        .join(asked.hint("merge"), ["key", "_row_id"], "left_semi")
        .select("key", "text")
        .mapInArrow(_shingle_sets, "key binary, shingle_set binary")
        .dropDuplicates(["key"]),
        "shingle-sets",
    )
    asked_texts = met_texts.join(held, "key").join(counted.select("key", "copies"), "key")
    rows = wanted.join(asked_texts, "key")
    links = written(link_counts(rows, _verified(similarity, trees, length)), "text-links")
    return with_components(signed.select("doc_id", "key"), counted, links, "doc_id").select(
        "doc_id", "key", "n_links",
        F.col("n_distinct_links").alias("n_text_links"),
        F.col("component_id").alias("class_id"),
        "root",
    )


def without_near_copies(docs: DataFrame, **options) -> DataFrame:
    """One document of every group: the one with the smallest doc_id.

    Where that id stands on several texts of the group, the text with the smallest
    digest stays; rows that repeat both id and text are one document. Documents
    without a word stay as they are.
    """
    groups = jaccard_groups(docs, **options)
    groups = written(groups.filter("key IS NOT NULL"), "text-groups")
    first = F.col("doc_id").eqNullSafe(F.col("class_id"))
    gone = groups.filter(~first).select("doc_id", "key")
    heads = groups.filter(first & (F.col("n_links") > 0)).select("root", "doc_id", "key").distinct()
    stays = heads.groupBy("root").agg(F.min("key").alias("stays"), F.count("*").alias("n"))
    stays = written(stays.filter("n > 1"), "heads")
    more = heads.join(stays, "root").filter("key <> stays").select("doc_id", "key")
    # One plain key for both the join and the window, so that texts are dealt once.
    row_id = _row_id("doc_id")
    gone = gone.union(more).select("key", row_id).distinct().withColumnRenamed("key", "_text_key")
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.filter(worded).select("*", _key(F.col("text")).alias("_text_key"), row_id)
    left = keyed.join(gone.hint("merge"), ["_text_key", "_row_id"], "left_anti")
    once = Window.partitionBy("_text_key", "_row_id").orderBy("_text_key")
    left = left.withColumn("_nth", F.row_number().over(once)).filter("_nth = 1")
    return left.select(docs.columns).unionByName(docs.filter(~worded))
