"""Texts of an Arrow batch as byte arrays: words, hashes of words and of word windows.

Everything here works on UTF-8 bytes of many texts at once, so a task holds one slice of a
batch (``SLICE_BYTES``, or a single longer text) and a few arrays of its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
SET_BYTES = 1 << 19  # for sets of shingles, which take most of a task's Python memory

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
_RADIX = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2**64
_MASK = (1 << 64) - 1

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * _ODD)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _radix_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse, kept for slices of the usual size."""
    global _powers
    if _powers is not None and len(_powers[0]) >= n:
        return _powers
    size = max(1 << (n - 2).bit_length(), SET_BYTES) + 1
    found = []
    for base in (_RADIX, pow(_RADIX, -1, 1 << 64)):
        steps = np.full(size, U64(base & _MASK))
        steps[0] = 1
        found.append(np.multiply.accumulate(steps))
    if n <= SLICE_BYTES + 1:
        # Sizes are powers of two, so they are worked out a few times only.
        _powers = (found[0], found[1])
    return found[0], found[1]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES, most_rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, bytes, bounds)`` of consecutive slices of the texts.

    Text ``i`` of a slice is ``bytes[bounds[i]:bounds[i + 1]]``; a null reads as empty. A slice
    has at most ``limit`` bytes unless one text alone is longer, and at most ``most_rows`` texts.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    rows = len(column)
    if not rows:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + rows + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), at + most_rows, rows)
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and ``first``: text ``i`` has words ``first[i]:first[i + 1]``."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~separators[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running sum over the slice."""
    powers, inverse = _radix_powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE_CODES[data] * powers[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64) * _ODD)


def sequence_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each range of word hashes, of any length."""
    powers, inverse = _radix_powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=U64)
    np.cumsum(mix(words + _ODD) * powers[:len(words)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64) * _ODD)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive word hashes; element ``i`` starts at word ``i``."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    total = np.zeros(n, dtype=U64)
    for j in range(size):
        total = total * U64(_RADIX) + words[j:j + n]
    return mix(total)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct hashes)`` of each text's word shingles, ASCII letters lower-cased.

    A text of fewer words than ``size`` has its whole word sequence as the only shingle; a text
    without words, or a null, has none. Hashes are signed, as Spark's are.
    """
    for at, to, data, bounds in text_slices(column, SET_BYTES):
        data = ASCII_LOWER[data]
        starts, ends, first = word_spans(data, bounds, SPACES)
        words = span_hashes(data, starts, ends)
        windows = window_hashes(words, size)
        for i in range(to - at):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= size:
                yield at + i, np.unique(windows[lo:hi - size + 1].view(np.int64))
            elif hi > lo:
                yield at + i, window_hashes(words[lo:hi], int(hi - lo)).view(np.int64)
            else:
                yield at + i, np.zeros(0, np.int64)
