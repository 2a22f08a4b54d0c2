"""Byte and word hashing over Arrow string columns, vectorised with numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D, so UTF-8 text needs no decoding.
All hashes are fixed functions of the bytes: reruns and lost executors give the same values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
BYTE_VALUES[_SEPARATOR] = 0
LOWER_VALUES[_SEPARATOR] = 0

_powers = np.ones(1, np.uint64)
#: Powers a worker keeps; longer words have theirs made anew.
_KEPT_POWERS = 1 << 16


def powers(n: int) -> np.ndarray:
    """The first n powers (or more) of a fixed odd multiplier, modulo 2**64."""
    global _powers
    if len(_powers) >= n:
        return _powers
    steps = np.full(max(n, 1 << 12), _ODD, np.uint64)
    steps[0] = 1
    made = np.cumprod(steps)
    if n <= _KEPT_POWERS:
        _powers = made
    return made


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column in one array, and the n + 1 row offsets; null is empty.

    Memory that earlier batches have given back to Arrow's pool goes back to the system first: workers outlive their stage.
    """
    pa.default_memory_pool().release_unused()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n + 1 word offsets of the rows."""
    inside = ~_SEPARATOR[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~cut[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate((inside[1:], [False])) & ~cut[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """A 64-bit hash of every word; ``LOWER_VALUES`` reads A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = int(starts[0])
    gaps = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data) - first, dtype=np.int32) - np.repeat((starts - first).astype(np.int32), gaps)
    terms = values[data[first:]]
    terms *= powers(int(gaps.max()))[place]
    return mix(np.add.reduceat(terms, starts - first) ^ ((ends - starts).astype(np.uint64) * _ODD))


def rolling(items: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` items from every place on; places too near the end hash what is there."""
    total, done, block, size, at = None, 0, items, 1, powers(width + 1)
    rest = width
    while rest:
        if rest & 1:
            part = _shifted(block, done) * at[done] if done else block.copy()
            total = part if total is None else total + part
            done += size
        rest >>= 1
        if rest:
            block = block + _shifted(block, size) * at[size]
            size *= 2
    return mix(total)


def _shifted(items: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(items)
    if by < len(items):
        out[: len(items) - by] = items[by:]
    return out


def fits(offsets: np.ndarray, width: int) -> np.ndarray:
    """Per item, whether ``width`` items from it on lie in its own row."""
    last = np.repeat(offsets[1:], np.diff(offsets))
    return np.arange(len(last)) + width <= last


def covered(starts: np.ndarray, width: int) -> np.ndarray:
    """Items covered by a window of ``width`` at a marked start."""
    seen = np.cumsum(starts, dtype=np.int64)
    seen[width:] -= seen[:-width].copy() if len(seen) > width else seen[:0]
    return seen > 0


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values
