"""Embeddings as integer vectors, in numpy over Arrow batches, and packed in blocks that are read many times.

A vector is usable when it is not null and holds finite numbers only. Its entries are read as ``floor(scale * entry)``; beyond
``limit`` they stay at the limit, so that sums of squares fit their types.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: About so many bytes of packed entries in a block.
BLOCK_BYTES = 256 << 10

_KINDS = (np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))


def usable(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))


def integers(column: pa.Array, width: int, scale: int, limit: int, shorter: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a usable vector of ``width`` entries (or of fewer, filled up with 0), and their integers as a matrix."""
    column = column.cast(pa.large_list(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    numbers = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), sizes)
    bad = np.bincount(row, ~np.isfinite(numbers), len(column)) > 0
    keep = column.is_valid().to_numpy(zero_copy_only=False) & ~bad & ((sizes <= width) if shorter else (sizes == width))
    out = np.zeros((int(keep.sum()), width), np.int64)
    chosen = keep[row]
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(numbers[chosen] * scale), -limit, limit)
    out[(np.cumsum(keep) - 1)[row[chosen]], place[chosen]] = scaled.astype(np.int64)
    return np.flatnonzero(keep), out


def narrowest(matrix: np.ndarray) -> np.ndarray:
    """For each row, the place in ``_KINDS`` of the narrowest type that holds it."""
    most = np.abs(matrix).max(axis=1, initial=0)
    return (most > np.iinfo(np.int16).max).astype(int) + (most > np.iinfo(np.int32).max)


def row_keys(matrix: np.ndarray) -> pa.Array:
    """Every row as bytes, equal for equal rows."""
    kinds, parts = narrowest(matrix), []
    for k, kind in enumerate(_KINDS):
        rows = matrix[kinds == k].astype(kind)
        ends = np.arange(len(rows) + 1, dtype=np.int64) * (rows.shape[1] * kind.itemsize)
        parts.append(pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())]))
    return pa.concat_arrays(parts).cast(pa.binary())


def from_keys(keys: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(keys), width), np.int64)
    sizes = pc.binary_length(keys).to_numpy(zero_copy_only=False)
    for kind in _KINDS:
        rows = np.flatnonzero(sizes == width * kind.itemsize)
        if len(rows) and width:
            out[rows] = np.frombuffer(b"".join(keys.take(pa.array(rows)).to_pylist()), kind).reshape(-1, width)
    return out


def blocks(matrix: np.ndarray, ids: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
    """Rows (width, item, data) and, with ids, the list of the block's ids."""
    width = matrix.shape[1]
    kind = _KINDS[int(narrowest(matrix).max(initial=0))]
    step = max(1, BLOCK_BYTES // max(1, width * kind.itemsize))
    for first in range(0, len(matrix), step):
        part = matrix[first : first + step].astype(kind)
        columns = [pa.array([len(part)], pa.int32()), pa.array([kind.itemsize], pa.int32()), pa.array([part.tobytes()], pa.binary())]
        names = ["n", "item", "data"]
        if ids is not None:
            own = ids.slice(first, step)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)


BLOCK_SCHEMA = "n int, item int, data binary"


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array | None]]:
    """The matrix of every block, and its ids where it has them."""
    for batch in batches:
        for k in range(batch.num_rows):
            n, item = batch.column("n")[k].as_py(), batch.column("item")[k].as_py()
            data = np.frombuffer(batch.column("data")[k].as_buffer(), f"<i{item}").reshape(n, -1)
            yield data, batch.column("ids")[k].values if "ids" in batch.schema.names else None
