"""Token-bucket admission over a request log.

A client's bucket is one number, ``open``: the time at which a whole token will be
there. A request at ``t`` passes if ``t >= open``; then ``open`` moves up by the
time one token takes, but a bucket never holds more than ``capacity`` tokens:

    open = max(open, t - (capacity - 1) * step) + step

Times are scaled by the capacity, so ``step`` is the window length and all
arithmetic is exact in integers.

A client's log may be a third of all rows, so it is not walked in one task. The log of
a client with many rows is cut into chunks of time. Each chunk is turned into its
effect, a short list saying which ``open`` leads to which; chaining the effects gives
the ``open`` that each chunk begins with, and then all chunks are replayed at once.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tradelake.operators.stretches import Stretches
from tradelake.session import written

FULL = -(1 << 62)
EFFECT = "low array<bigint>, move array<bigint>, fixed array<boolean>"
#: Rows of a key that one task walks, up to twice as many.
ROWS_PER_CHUNK = 1_000_000


class Effect(NamedTuple):
    """What a run of requests does to ``open``, as pieces over its value before.

    Piece i covers values from ``low[i]`` up to the next piece; there ``open``
    becomes ``move[i]`` if ``fixed[i]``, else grows by ``move[i]``.
    """

    low: np.ndarray
    move: np.ndarray
    fixed: np.ndarray

    def of(self, value: int) -> int:
        piece = int(np.searchsorted(self.low, value, side="right")) - 1
        return int(self.move[piece]) + (0 if self.fixed[piece] else value)

    def then(self, other: Effect) -> Effect:
        """This effect followed by another, pieces split where the other's begin."""
        start = np.where(self.fixed, self.move, self.low + self.move)
        last = np.append(self.low[1:], -FULL) + self.move - 1
        last = np.where(self.fixed, self.move, last)
        begin = np.searchsorted(other.low, start, side="right") - 1
        count = np.searchsorted(other.low, last, side="right") - begin
        mine = np.repeat(np.arange(len(self.low)), count)
        nth = np.arange(len(mine)) - np.repeat(np.cumsum(count) - count, count)
        theirs = begin[mine] + nth
        low = np.where(nth == 0, self.low[mine], other.low[theirs] - self.move[mine])
        stays = other.fixed[theirs]
        move = other.move[theirs] + np.where(stays, 0, self.move[mine])
        return _joined(low, move, stays | self.fixed[mine])


def _joined(low: np.ndarray, move: np.ndarray, fixed: np.ndarray) -> Effect:
    """Neighbouring pieces that do the same become one."""
    new = np.append(True, (move[1:] != move[:-1]) | (fixed[1:] != fixed[:-1]))
    return Effect(low[new], move[new], fixed[new])


def effect_of(times: np.ndarray, step: int, capacity: int, first_open: int) -> Effect:
    """Effect of a run of requests, given its scaled times in order.

    ``open`` is never more than one step after a request that passed, so values
    beyond that, and beyond ``first_open``, need not be covered.
    """
    end = max(int(times[0]) + step, first_open) + 1
    if capacity == 1:
        return _jumps(times, step, end)
    return _Pieces(step, capacity, end).feed(times.tolist())


def _jumps(times: np.ndarray, step: int, end: int) -> Effect:
    """Capacity 1: from any request the next to pass is known at once."""
    n = len(times)
    following = np.searchsorted(times, times + step)
    last = np.where(following < n, following, np.arange(n))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    low = np.concatenate([[FULL], times + 1])
    move = np.append(times[last] + step, 0)
    fixed = np.append(np.ones(n, dtype=bool), False)
    return _joined(*(part[low < end] for part in (low, move, fixed)))


class _Pieces:
    """Pieces (low, high, move, fixed) of the effect, taken from request to request.

    Many pieces come to lead to the same few values. Then the effect so far is put
    aside and the walk goes on from those values; the parts are chained at the end.
    """

    LOOK_EVERY = 128

    def __init__(self, step: int, capacity: int, end: int):
        self.step, self.capacity, self.burst = step, capacity, (capacity - 1) * step
        self.done: list[Effect] = []
        self.pieces = [(FULL, end, 0, False)]

    def feed(self, times: list[int]) -> Effect:
        i = steps = 0
        while i < len(times):
            if len(self.pieces) == 1 and self.pieces[0][3]:
                # What came before no longer matters.
                low, high, value, _ = self.pieces[0]
                _, _, value = replay(times[i:], value, self.step, self.capacity)
                self.pieces = [(low, high, value, True)]
                break
            # Requests before the earliest possible ``open`` change nothing.
            soonest = min(move if fixed else low + move for low, _, move, fixed in self.pieces)
            if times[i] < soonest:
                i = bisect_left(times, soonest, i)
                continue
            self._request(times[i])
            i, steps = i + 1, steps + 1
            if steps % self.LOOK_EVERY == 0:
                self._put_aside()
        whole = self._effect()
        for part in reversed(self.done):
            whole = part.then(whole)
        return whole

    def _effect(self) -> Effect:
        low, _, move, fixed = zip(*self.pieces, strict=True)
        return Effect(np.array(low), np.array(move), np.array(fixed))

    def _request(self, t: int) -> None:
        floor, step, pieces = t - self.burst, self.step, []
        for low, high, move, fixed in self.pieces:
            if fixed:
                if move <= t:
                    move = max(move, floor) + step
                _add(pieces, low, high, move, True)
                continue
            if low + move <= floor:
                cut = min(high, floor + 1 - move)
                _add(pieces, low, cut, floor + step, True)
                low = cut
            if low < high and low + move <= t:
                cut = min(high, t + 1 - move)
                _add(pieces, low, cut, move + step, False)
                low = cut
            if low < high:
                _add(pieces, low, high, move, False)
        self.pieces = pieces

    def _put_aside(self) -> None:
        values = sorted(
            (move, move + 1) if fixed else (low + move, high + move)
            for low, high, move, fixed in self.pieces
        )
        merged = []
        for low, high in values:
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        if 2 * len(merged) <= len(self.pieces):
            self.done.append(self._effect())
            self.pieces = [(low, high, 0, False) for low, high in merged]


def _add(pieces: list, low: int, high: int, move: int, fixed: bool) -> None:
    """Append a piece, or extend the last one if it does the same."""
    if pieces and pieces[-1][2] == move and pieces[-1][3] == fixed:
        pieces[-1] = (pieces[-1][0], high, move, fixed)
    else:
        pieces.append((low, high, move, fixed))


def replay(times: list[int], value: int, step: int, capacity: int):
    """Positions of the requests that pass, ``open`` after each, and at the end."""
    burst, passed, opens, i = (capacity - 1) * step, [], [], 0
    while i < len(times):
        if times[i] < value:
            i = bisect_left(times, value, i)
            continue
        value = max(value, times[i] - burst) + step
        passed.append(i)
        opens.append(value)
        i += 1
    return passed, opens, value


def _runs(batch: pa.RecordBatch, key: str) -> Iterator[tuple[tuple, int, int]]:
    """Consecutive rows with the same key and chunk, nulls being a key like any other."""
    if batch.num_rows == 0:
        return
    column, chunks = batch.column(key), batch.column("chunk")
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
    new = (np.diff(codes) != 0) | (np.diff(chunks.to_numpy()) != 0)
    starts = np.append(0, np.flatnonzero(new) + 1)
    for start, end in zip(starts, np.append(starts[1:], len(codes)), strict=True):
        here = (column[int(start)].as_py(), chunks[int(start)].as_py())
        yield here, int(start), int(end)


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _effects(key: str, capacity: int, window_ms: int, first_open: int, schema: pa.Schema):
    """One effect per key and chunk, of rows sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []

        def row() -> pa.RecordBatch:
            times = np.concatenate(parts)
            effect = effect_of(times, window_ms, capacity, first_open)
            return _batch(schema, *([value] for value in (*at, *effect)))

        for batch in batches:
            times = batch.column("at_ms").to_numpy() * capacity
            for here, start, end in _runs(batch, key):
                if here != at:
                    if parts:
                        yield row()
                    at, parts = here, []
                parts.append(times[start:end])
        if parts:
            yield row()

    return run


def _rows(batches: Iterator[pa.RecordBatch], key: str, place: str):
    """Key, place, effect and, where there is one, the ``open`` before it."""
    for batch in batches:
        opens = batch.column("open") if "open" in batch.schema.names else None
        for i in range(batch.num_rows):
            effect = Effect(
                *(np.asarray(batch.column(n)[i].values) for n in Effect._fields)
            )
            known = opens[i].as_py() if opens is not None else None
            yield batch.column(key)[i].as_py(), batch.column(place)[i].as_py(), effect, known


def _blocks(key: str, schema: pa.Schema):
    """One effect per key and block, of chunk effects sorted by key and chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, whole = None, None
        for this, block, effect, _ in _rows(batches, key, "block"):
            if at == (this, block):
                whole = whole.then(effect)
                continue
            if whole is not None:
                yield _batch(schema, *([value] for value in (*at, *whole)))
            at, whole = (this, block), effect
        if whole is not None:
            yield _batch(schema, *([value] for value in (*at, *whole)))

    return run


def _openings(key: str, place: str, first_open: int, schema: pa.Schema):
    """The ``open`` before every place, of effects sorted by key and place.

    A key begins with ``first_open``, unless the rows bring the ``open`` that holds
    before the first place of their block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, value, given = object(), first_open, None
        for this, where, effect, known in _rows(batches, key, place):
            if this != current or known != given:
                current, given = this, known
                value = first_open if known is None else known
            yield _batch(schema, [this], [where], [value])
            value = effect.of(value)

    return run


def _replays(key: str, capacity: int, window_ms: int, first_open: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, value = object(), first_open
        for batch in batches:
            times = batch.column("at_ms").to_numpy() * capacity
            given = batch.column("open")
            admitted = np.zeros(batch.num_rows, dtype=bool)
            after = np.full(batch.num_rows, FULL, dtype=np.int64)
            for here, start, end in _runs(batch, key):
                if here != current:
                    current = here
                    opening = given[start].as_py()
                    value = first_open if opening is None else opening
                after[start] = value
                passed, opens, value = replay(
                    times[start:end].tolist(), value, window_ms, capacity
                )
                admitted[start:end][passed] = True
                after[start:end][passed] = opens
                # ``open`` never falls, so the largest so far is the current one.
                np.maximum.accumulate(after[start:end], out=after[start:end])
            names = [n for n in batch.schema.names if n not in ("chunk", "open")]
            kept = [batch.column(n) for n in names]
            # With capacity 1, ``open`` is one window after the last admission.
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(admitted), pa.array(after - window_ms), pa.array(after)],
                names=[*names, "admitted", "window_start_ms", "open"],
            )

    return run


def admit(
    log: DataFrame,
    key: str,
    capacity: int,
    window_ms: int,
    first_open_ms: int | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    openings: DataFrame | None = None,
) -> DataFrame:
    """Add ``admitted`` to requests ordered by (``at_ms``, ``seq``) per ``key``.

    A key begins with a full bucket, or with ``first_open_ms`` when given, or with
    its ``open`` in ``openings`` (``key``, ``open``). ``open`` is also added: the
    bucket after the request. For capacity 1, ``window_start_ms`` is the time of the
    last admitted request.

    The cuts of large keys are stored, not the log: both passes read the log and give
    a row the same chunk.
    """
    first_open = FULL if first_open_ms is None else first_open_ms * capacity
    schema = T.StructType([log.schema[key], T.StructField("open", T.LongType())])
    if openings is None:
        openings = log.sparkSession.createDataFrame([], schema)
    known = openings.select(F.col(key).alias("_o"), F.col("open").alias("_opening"))
    stretches = Stretches(log, [key], rows_per_chunk)
    split = stretches.place(log.select(key, "at_ms", "seq"), "inner")
    placed = split.repartition(key, "chunk").sortWithinPartitions(key, "chunk", "at_ms")
    effects = placed.mapInArrow(
        *_stage(_effects, log, key, "chunk", EFFECT, capacity, window_ms, first_open)
    )
    begun = written(_chunk_openings(effects, log, key, known, first_open), "chunk-openings")
    begun = begun.select(F.col(key).alias("_k"), F.col("chunk").alias("_c"), "open")
    opened = (
        stretches.place(log)
        .join(begun, F.col(key).eqNullSafe(F.col("_k")) & (F.col("chunk") == F.col("_c")), "left")
        .join(known, F.col(key).eqNullSafe(F.col("_o")), "left")
        .select(*log.columns, "chunk", F.coalesce("open", "_opening").alias("open"))
    )
    result_schema = T.StructType(
        [
            *log.schema.fields,
            T.StructField("admitted", T.BooleanType()),
            T.StructField("window_start_ms", T.LongType()),
            T.StructField("open", T.LongType()),
        ]
    )
    return (
        opened.repartition(key, "chunk")
        .sortWithinPartitions(key, "chunk", "at_ms", "seq")
        .mapInArrow(_replays(key, capacity, window_ms, first_open), result_schema)
    )


def _stage(make, log: DataFrame, key: str, place: str, rest: str, *arguments):
    """A function for mapInArrow and its schema: key, place and ``rest``."""
    schema = T.StructType(
        [log.schema[key], T.StructField(place, T.LongType()), *T._parse_datatype_string(rest)]
    )
    return make(key, *arguments, to_arrow_schema(schema)), schema


def _chunk_openings(
    effects: DataFrame, log: DataFrame, key: str, known: DataFrame, first_open: int
) -> DataFrame:
    """The ``open`` before every chunk of the large keys.

    Chained in blocks: first each block of chunks is made one effect, then a key's
    blocks are chained, then the chunks in each block, so no task sees more than the
    square root of a key's chunks.
    """
    effects = written(effects, "chunk-effects")
    size = math.isqrt(effects.agg(F.max("chunk")).first()[0] or 0) + 1
    blocked = effects.withColumn("block", F.expr(f"chunk div {size}L"))
    spread = blocked.repartition(key, "block").sortWithinPartitions(key, "chunk")
    blocks = spread.mapInArrow(*_stage(_blocks, log, key, "block", EFFECT))
    # A key's first block begins with what is known of it, and so do all that follow.
    blocks = blocks.join(known, F.col(key).eqNullSafe(F.col("_o")), "left").select(
        key, "block", *Effect._fields, F.col("_opening").alias("open")
    )

    def chained(rows: DataFrame, place: str, *by: str) -> DataFrame:
        placed = rows.repartition(key, *by).sortWithinPartitions(key, place)
        return placed.mapInArrow(
            *_stage(_openings, log, key, place, "open bigint", place, first_open)
        )

    before = written(chained(blocks, "block"), "block-openings").select(
        F.col(key).alias("_k"), F.col("block").alias("_b"), "open"
    )
    same = F.col("_k").eqNullSafe(F.col(key)) & (F.col("_b") == F.col("block"))
    opened = blocked.join(before, same).select(*blocked.columns, "open")
    return chained(opened, "chunk", "block")


def rate_limit_flags(
    requests: DataFrame,
    max_requests: int = 500,
    window_ms: int = 10_000,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add ``allowed`` to a request log by client; loopback clients always pass.

    ``loopback`` is an optional flag column; ``max_requests`` 0 turns limiting off.
    """
    if max_requests == 0:
        return requests.withColumn("allowed", F.lit(True))
    local = (
        F.coalesce("loopback", F.lit(False)) if "loopback" in requests.columns else F.lit(False)
    )
    checked = admit(
        requests, "client", max_requests, window_ms, rows_per_chunk=rows_per_chunk
    )
    return checked.withColumn("allowed", local | F.col("admitted")).drop(
        "admitted", "window_start_ms", "open"
    )
