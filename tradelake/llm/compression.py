"""Quality rules from compression: text that repeats itself, or that is no text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = 3
CHUNK = 2048
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
#: Odd multipliers that turn a window of word hashes into one number.
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


@dataclass(frozen=True)
class Band:
    """Limits of compressed size / size for texts of at least ``size`` bytes."""

    size: int
    low: float
    high: float


#: Short texts compress badly whatever they are, long prose to two fifths or so;
#: base64 stays above three quarters, repeated words fall below a fifth.
BANDS = (
    Band(0, 0.0, float("inf")),
    Band(128, 0.30, 1.10),
    Band(512, 0.26, 0.80),
    Band(2048, 0.22, 0.74),
    Band(8192, 0.20, 0.70),
)


def within(size: int, packed: int, bands: tuple[Band, ...] = BANDS) -> bool:
    """Whether a text of ``size`` bytes may compress to ``packed``."""
    band = next(b for b in reversed(bands) if size >= b.size)
    return band.low * size <= packed <= band.high * size


def chunks(data: bytes, chunk: int = CHUNK) -> list[bytes]:
    """Fixed chunks; a rest of less than half a chunk stays with the one before it."""
    count = max(1, (len(data) + chunk // 2) // chunk)
    cuts = [i * chunk for i in range(count)] + [len(data)]
    return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five words that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    windows = hashes[:n] * _MIX[0]
    for k in range(1, WINDOW):
        windows = (windows ^ (windows >> np.uint64(29))) + hashes[k : n + k] * _MIX[k]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    begins = np.flatnonzero(np.isin(windows, twice))
    # Each window covers five words, less what the window before it has covered.
    return int(np.minimum(np.diff(begins, append=begins[-1] + WINDOW), WINDOW).sum())


def measures(text: str | None, compressor: zstandard.ZstdCompressor) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio, bad_chunks, within limits."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    packed = len(compressor.compress(data))
    parts = chunks(data)
    if len(parts) == 1:
        bad = int(not within(len(data), packed))
    else:
        bad = sum(not within(len(part), len(compressor.compress(part))) for part in parts)
    return (
        len(words),
        len(text) - (len(data) - len(data.translate(None, BLANKS))),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        packed / len(data) if data else 0.0,
        bad,
        within(len(data), packed) and not bad,
    )


_NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "bad_chunks", "within",
)
_KINDS = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.bool_()]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        rows = [measures(text.as_py(), compressor) for text in batch.column("text")]
        columns = zip(*rows, strict=True) if rows else [[] for _ in _NAMES]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, _KINDS, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *_NAMES])


def compression_rules(docs: DataFrame) -> DataFrame:
    """Base measures and the compression verdict of every whole text.

    The text as a whole and each of its fixed chunks are compressed with zstandard;
    the ratio must lie within the limits of its length (``BANDS``), so both a text
    that repeats itself and a passage that cannot be compressed are found. Before
    that, texts of under ten words or with over a fifth of repeated words fail.

    Columns: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``ratio``, ``bad_chunks``, ``base_failed``, ``kept``. A null
    text counts as empty and fails. Rows are judged one by one, whatever their ids;
    other columns are ignored; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    measured = docs.select("doc_id", "text").mapInArrow(
        _measure,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, ratio double, bad_chunks long, within boolean",
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).select(
        "doc_id", *_NAMES[:-1], "base_failed", (~F.col("base_failed") & F.col("within")).alias("kept")
    )
