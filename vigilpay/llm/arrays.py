"""Texts of an Arrow batch as flat numpy arrays: bytes, word spans, hashes.

Used inside tasks, a bounded number of bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task turns into arrays at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 21
_RADIX = 0x9E3779B97F4A7C15 | 1
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)


def _random_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_TABLES = {0: _random_table(11), 1: _random_table(12)}
_POWERS: dict[str, np.ndarray] = {}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and where each begins (one more than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(starts):
        starts = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or one longer text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the first word of every text (one more than texts)."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[(offsets > 0) & (offsets < n)]
        before[edges] = False
        after[edges - 1] = False
    begins, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return begins, ends, np.searchsorted(begins, offsets)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _RADIX), ("down", _RADIX_INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Sums from which the hash of any span follows (``span_hashes``)."""
    up, _ = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLES[which][data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span lies."""
    _, down = _powers(len(sums))
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h *= np.uint64(_RADIX)
        h += values[k : k + n]
    return mix(h)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length) on end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def covered(n: int, begins: np.ndarray, width: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``width`` that begins at one of ``begins``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, np.minimum(begins + width, n), -1)
    return np.cumsum(change[:-1]) > 0
