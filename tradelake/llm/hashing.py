"""Hashes of all words of many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Odd multipliers: the base of the rolling sum and its inverse, the final mix, shingles.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_FINAL = np.uint64(0xD6E8FEB86659FD93)
_SHINGLE = np.array(
    [0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F],
    dtype=np.uint64,
)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(b" \t\n\r\x0b\x0c")] = True
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


@lru_cache(maxsize=2)
def _powers(base: int, count: int) -> np.ndarray:
    """Powers of ``base`` modulo 2**64, by doubling."""
    powers = np.ones(1, dtype=np.uint64)
    while len(powers) < count:
        powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), 1 << 64))])
    return powers


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _FINAL
    values = (values ^ (values >> np.uint64(29))) * _FINAL
    return values ^ (values >> np.uint64(32))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and where each text's words start.

    A word's hash is the sum of its bytes' values times powers of a base; running
    sums over all texts give every word's sum at once. The starts have one entry more
    than there are texts.
    """
    data = [text.encode() for text in texts]
    joined = np.frombuffer(b"\n".join([b"", *data, b""]), dtype=np.uint8)
    sizes = np.array([len(d) + 1 for d in data], dtype=np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    blank = _BLANK[joined]
    change = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begins, ends = change[::2], change[1::2]
    room = 1 << max(20, (len(joined) - 1).bit_length())
    rising, falling = _powers(_BASE, room), _powers(_INVERSE, room)
    sums = np.cumsum(_BYTES[joined] * rising[: len(joined)])
    hashes = (sums[ends - 1] - sums[begins - 1]) * falling[begins] + (ends - begins).astype(np.uint64)
    return mixed(hashes), np.searchsorted(begins, edges)


def shingle_hashes(hashes: np.ndarray, starts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words, and where each text's windows start.

    A text of fewer words has one window of all its words; one without any has none.
    """
    counts = np.diff(starts)
    m = max(len(hashes) - size + 1, 0)
    windows = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(size):
        windows[:m] = mixed(windows[:m] + hashes[k : m + k] * _SHINGLE[k])
    short = np.flatnonzero((counts > 0) & (counts < size))
    for i in short:
        value = np.zeros(1, dtype=np.uint64)
        for k in range(counts[i]):
            value = mixed(value + hashes[starts[i] + k : starts[i] + k + 1] * _SHINGLE[k])
        windows[starts[i]] = value[0] + np.uint64(counts[i])
    numbers = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(numbers)])
    take = np.arange(ends[-1]) - np.repeat(ends[:-1], numbers) + np.repeat(starts[:-1], numbers)
    return windows[take], ends
