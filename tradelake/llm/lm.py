"""Cross-entropy difference between a target and a background n-gram model."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradelake.llm.common import WORD, runs, word_count, written
from tradelake.llm.hashing import mixed, word_hashes

#: Weight of the pair estimate, and what is added to every word count.
PAIR_WEIGHT = 0.7
ADDED = 0.1
#: Distinct words that a task adds up before it hands them on.
HELD = 1 << 20
#: Characters of the texts that are counted and scored together: at least, at most, and
#: as the share of all (a power of two) that lies between.
CHUNK, LARGEST_CHUNK, CHUNK_SHARE = 1 << 23, 1 << 25, 14
#: Chunks over which the rows of one id are spread, and the share of all rows (one in so
#: many) beyond which an id's rows may go to any chunk.
SALTS, OFTEN = 4, 1000
#: Least number of the parts of the counts, and characters of text for each.
BUCKETS, BUCKET = 1 << 8, 1 << 25
#: Bits of a key within its bucket.
KEPT = 48
ASKED = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("asked", pa.binary())])
#: What stands before a text's first word and after its last.
EDGE = np.uint64(0x5851F42D4C957F2C)
_PAIR = np.uint64(0xA24BAED4963EE407)


def events(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What the models predict in the texts: every word, and the end of a text.

    Keys of the events, of what stands before them and of both together, and how many
    events each text has: one more than its words, none if it has no word.
    """
    word, starts = word_hashes(texts)
    some = np.diff(starts) > 0
    event = np.insert(word, starts[1:][some], EDGE)
    before = np.concatenate([np.full(min(len(event), 1), EDGE), event[:-1]])
    return event, before, mixed(before * _PAIR + event), np.diff(starts) + some


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of a task."""
    found: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for run in runs(batch.column("text").to_pylist()):
            found.append(np.unique(word_hashes(run)[0]))
            size += len(found[-1])
            if size >= HELD:
                found = [np.unique(np.concatenate(found))]
                size = len(found[0])
                if size >= HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64))], ["word"])
                    found, size = [], 0
    if size:
        words = np.unique(np.concatenate(found)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(words)], ["word"])


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length of numbers from 0, byte by byte of their places, compressed."""
    parts = [len(arrays[0]).to_bytes(8, "little")]
    for values in arrays:
        width = (int(values.max(initial=0)).bit_length() + 7) // 8
        parts.append(bytes([width]))
        parts.append(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(raw: bytes) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    n, at, arrays = int(data[:8].view("<u8")[0]), 8, []
    while at < len(data):
        width = int(data[at])
        values = np.zeros((n, 8), np.uint8)
        values[:, :width] = data[at + 1 : at + 1 + n * width].reshape(width, n).T
        arrays.append(values.view("<u8").ravel())
        at += 1 + n * width
    return arrays


def _cuts(distinct: np.ndarray, bits: int) -> tuple[list[int], list[int]]:
    """Buckets of sorted keys, and the bounds of each bucket's keys."""
    bucket = distinct >> np.uint64(64 - bits)
    bounds = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(distinct)]
    return bucket[bounds[:-1]].astype(np.int64).tolist(), bounds


def _field(rows: pa.Table, name: str) -> pa.Array:
    row = rows.column("row").combine_chunks()
    return row.field(row.type.get_field_index(name))


def _targets(rows: pa.Table, marks: pa.Table) -> np.ndarray:
    """Which rows are of the target: known so before, or by an id of the chunk's marks."""
    ids = pc.is_in(_field(rows, "doc_id"), value_set=marks.column("good_id").combine_chunks())
    return pc.or_(rows.column("is_target").combine_chunks(), ids).to_numpy(zero_copy_only=False)


def _chunk(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of a chunk, in order; the places of all its events and then of
    all its pairs among them; and how many events each text has."""
    parts = [events(run) for run in runs(_field(rows, "text").to_pylist())]
    keys = np.concatenate([part[0] for part in parts] + [part[2] for part in parts])
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, place, np.concatenate([part[3] for part in parts])


def _asked(bits: int):
    """The distinct keys of a chunk and how often it has them, cut by bucket."""

    def ask(rows: pa.Table, marks: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return ASKED.empty_table()
        distinct, place, sizes = _chunk(rows)
        own = np.tile(np.repeat(_targets(rows, marks), sizes), 2)
        sums = [np.bincount(place, minlength=len(distinct)), np.bincount(place[own], minlength=len(distinct))]
        numbers, bounds = _cuts(distinct, bits)
        within = (distinct << np.uint64(bits)) >> np.uint64(64 - KEPT)
        asks = [
            packed(np.diff(within[a:b], prepend=np.uint64(0)), *(own[a:b] for own in sums))
            for a, b in zip(bounds, bounds[1:], strict=False)
        ]
        chunk = [rows.column("chunk")[0].as_py()] * len(asks)
        return pa.table([numbers, chunk, asks], schema=ASKED)

    return ask


def _answered(asks: pa.Table) -> pa.Table:
    """What a bucket knows of the keys that each chunk asks for, in the order of the keys.

    Counts of the background are sent less one, the asking text's own; of what the
    background has once, both counts are 0 then.
    """
    asked = [unpacked(raw) for raw in asks.column("asked").to_pylist()]
    within = [np.cumsum(steps) for steps, _, _ in asked]
    _, place = np.unique(np.concatenate(within), return_inverse=True)
    sums = [np.bincount(place, np.concatenate([own[k] for own in asked])).astype(np.int64) for k in (1, 2)]
    background = sums[0] - 1
    target = np.where(background > 0, sums[1], 0)
    bounds = np.cumsum([0, *map(len, within)])
    answers = [
        packed(background[place[a:b]], target[place[a:b]])
        for a, b in zip(bounds, bounds[1:], strict=False)
    ]
    return pa.table([asks.column("chunk"), asks.column("bucket"), pa.array(answers, pa.binary())], ["chunk", "bucket", "known"])


def probability(
    pair: np.ndarray, before: np.ndarray, single: np.ndarray, total: np.ndarray, n_words: int
) -> np.ndarray:
    """How likely an event is after another: ``PAIR_WEIGHT`` times its share among what
    follows that one, and the rest times its smoothed share of all events; the latter
    alone where nothing else is known to follow.

    The counts are of the pair, of what stands before, of the event and of all events;
    ``n_words`` is the number of distinct events. One more event stands for any that
    is not known, so the probabilities of all events after one another add up to 1.
    """
    weight = np.where(before > 0, PAIR_WEIGHT, 0.0)
    return weight * pair / np.maximum(before, 1) + (1 - weight) * (single + ADDED) / (total + ADDED * (n_words + 1))


def _judged(bits: int, n_words: int, totals: tuple[int, int]):
    """Losses of a chunk's texts, given the answers to all its keys, beside its marks."""

    def judge(rows: pa.Table, more: pa.Table) -> pa.Table:
        if not rows.num_rows:
            columns = [rows.column("row"), *(pa.array([], kind) for kind in (pa.int64(), pa.float64(), pa.float64()))]
            return pa.table(columns, ["row", "n_words", "target_loss", "background_loss"])
        is_mark = pc.is_null(more.column("bucket"))
        own = _targets(rows, more.filter(is_mark))
        answers = more.filter(pc.invert(is_mark))
        raw = dict(zip(answers.column("bucket").to_pylist(), answers.column("known").to_pylist(), strict=True))
        distinct, place, sizes = _chunk(rows)
        known = np.zeros((2, len(distinct)), np.int64)
        numbers, bounds = _cuts(distinct, bits)
        for number, a, b in zip(numbers, bounds, bounds[1:], strict=False):
            known[:, a:b] = unpacked(raw[number])
        event, pair = np.split(place, 2)
        # A text's last event is the edge that stands before the next text's first.
        before = np.concatenate([event[-1:], event[:-1]])
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        own = np.repeat(own, sizes).astype(np.int64)
        means = []
        # The background's counts come without the event itself, the target's with it.
        for counts, off, total in zip(known, (0, own), (totals[0] - 1, totals[1] - own), strict=True):
            others = [np.maximum(counts[at] - off, 0) for at in (pair, before, event)]
            loss = -np.log(probability(*others, total, n_words))
            means.append(np.add.reduceat(loss, begins) / sizes)
        arrays = [rows.column("row"), pa.array(sizes - 1), pa.array(means[1]), pa.array(means[0])]
        return pa.table(arrays, ["row", "n_words", "target_loss", "background_loss"])

    return judge


def _chunked(docs: DataFrame, good: DataFrame, sizes: DataFrame, n_rows: int, chunks: int) -> tuple[DataFrame, DataFrame]:
    """The documents with their ``chunk``, and the ids of good ones with theirs.

    A document's chunk follows from its id and one of ``SALTS`` numbers, taken from the
    part of the table in which it is read; a good id is sent to the chunks of all these
    numbers, so texts need not be shuffled to meet their labels. Ids that hold more than
    one in ``OFTEN`` rows, of which there are fewer than ``OFTEN``, are looked up
    instead, and their rows, like those without an id, go to any chunk.
    """
    often = sizes.filter(F.col("n_rows") * OFTEN > n_rows).filter(F.col("n_rows") > 1)
    often = often.join(good, "doc_id", "left").select(F.col("doc_id").alias("often_id"), "good")
    part = F.spark_partition_id()
    rows = docs.select(F.struct("*").alias("row"), part.alias("part"))
    rows = rows.join(F.broadcast(often), F.col("row.doc_id") == F.col("often_id"), "left")
    free = F.col("row.doc_id").isNull() | F.col("often_id").isNotNull()
    anywhere = F.xxhash64("row.doc_id", "row.text", "part")
    near = F.xxhash64("row.doc_id", F.pmod("part", F.lit(SALTS)))
    rows = rows.select(
        F.pmod(F.when(free, anywhere).otherwise(near), F.lit(chunks)).alias("chunk"),
        "row",
        F.coalesce("good", F.lit(False)).alias("is_target"),
    )
    salted = good.select("doc_id", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"))
    marks = salted.select(
        F.pmod(F.xxhash64("doc_id", "salt"), F.lit(chunks)).alias("chunk"), F.col("doc_id").alias("good_id")
    )
    return rows, marks.distinct()


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The cross-entropy difference of every whole text, under models of all others.

    Both models, of all documents and of those that ``labels`` call good, share one
    vocabulary: all words there are, and the end of a text. They know every word and
    every pair of neighbours. An event is judged by :func:`probability` with the counts
    of everything but itself, so what a model knows from that event alone is as good
    as unseen; in the target's counts only where the text is of the target.

    The texts are dealt into chunks, in the only exchange of texts. A chunk adds up its
    own keys (words and pairs) and sends each bucket of keys one row; the bucket adds up
    the rows of all chunks and answers each with the counts of its keys; the chunk scores
    its texts with the answers. So no model comes to one machine, and a frequent key is
    one entry of each chunk. Buckets follow the size of the corpus, and so do chunks
    between ``CHUNK`` and ``LARGEST_CHUNK`` characters. Equal rows, if they are many,
    share a chunk only where they are read together, in one part of the table.

    Columns: ``row`` (the document, all its columns), ``n_words``, ``target_loss``,
    ``background_loss`` (nats per event, of which a text has one more than words) and
    ``difference`` (target less background: the lower, the closer to the target). A text
    without a word, or null, has losses and a difference of 0. Equal texts of equal
    labels score alike; a null id is of no target; an empty table gives no rows.
    """
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    some = docs.filter(worded)
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    good = good.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType)).distinct()
    good = good.withColumn("good", F.lit(True))
    # A row per id, without texts: the totals, and which ids are frequent.
    sizes = some.groupBy("doc_id").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.length("text").cast("long")).alias("characters"),
        F.sum(word_count(F.col("text")) + 1).alias("events"),
    )
    sizes = written(sizes, "document-sizes")
    n_rows, characters, n_events = (
        n or 0 for n in sizes.agg(F.sum("n_rows"), F.sum("characters"), F.sum("events")).first()
    )
    in_target = sizes.join(good, "doc_id", "left_semi").agg(F.sum("events")).first()[0] or 0
    # The end of a text is one more.
    n_words = some.select("text").mapInArrow(_words, "word long").distinct().count() + 1

    bits = max(BUCKETS.bit_length() - 1, (characters // BUCKET).bit_length())
    chunks = characters // min(max(CHUNK, characters >> CHUNK_SHARE), LARGEST_CHUNK) + 1
    rows, marks = _chunked(some, good, sizes, n_rows, chunks)
    # Read twice below, dealt once: the planner reuses the exchange.
    rows = rows.repartition("chunk")
    asked = rows.groupBy("chunk").cogroup(marks.groupBy("chunk"))
    asked = asked.applyInArrow(_asked(bits), "bucket long, chunk long, asked binary")
    known = asked.groupBy("bucket").applyInArrow(_answered, "chunk long, bucket long, known binary")
    more = known.unionByName(marks, allowMissingColumns=True)
    answer = StructType([rows.schema["row"]])
    for name, kind in (("n_words", "long"), ("target_loss", "double"), ("background_loss", "double")):
        answer.add(name, kind)
    scored = rows.groupBy("chunk").cogroup(more.groupBy("chunk"))
    scored = scored.applyInArrow(_judged(bits, n_words, (n_events, in_target)), answer)
    zero = F.lit(0.0)
    blank = docs.filter(~worded).select(
        F.struct("*").alias("row"), F.lit(0).cast("long").alias("n_words"),
        zero.alias("target_loss"), zero.alias("background_loss"),
    )
    found = scored.unionByName(blank)
    return found.withColumn("difference", F.col("target_loss") - F.col("background_loss"))
