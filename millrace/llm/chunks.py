"""Documents in chunks on shared storage, and packed exchanges between chunks by hash.

A chunk holds the documents of a few megabytes of text, ordered by id, as one row. The chunks are
a bucketed table in the session's warehouse, so joining anything to them by chunk number moves the
other side only: texts are never shuffled. What chunks tell each other travels as packed arrays, one
row per chunk and hash range; a value that a third of all documents hold is one entry per chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as T

#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 3 << 20
#: Chunks whose packed values meet in one hash range.
CHUNKS_PER_RANGE = 6

SCHEMA = "chunk long, ids array<long>, sizes array<long>, body binary"


def _pack(limit: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def chunked(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, ends = T.column_bytes(batch.column(1))
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
                ids = batch.column(0).slice(first, last - first)
                order = np.array(pc.sort_indices(ids, null_placement="at_end"))
                body = b"".join(data[ends[first + i] : ends[first + i + 1]].tobytes() for i in order)
                sizes = np.diff(ends[first : last + 1])[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
                        pa.array([sizes], pa.list_(pa.int64())),
                        pa.array([body], pa.binary()),
                    ],
                    ["chunk", "ids", "sizes", "body"],
                )
                number += 1
                first = last

    return chunked


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = CHUNK_BYTES) -> DataFrame:
    """Write the chunks of ``docs``; null texts are empty, null ids come last in their chunk."""
    spark = docs.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    packed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    (
        packed.mapInArrow(_pack(limit), SCHEMA)
        .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk")
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return spark.table(name)


def ranges(chunks: DataFrame, per_range: int = CHUNKS_PER_RANGE) -> int:
    """How many hash ranges an exchange over these chunks should have."""
    return max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), chunks.count() // per_range)


def range_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """The range of each hash, as ``cut`` has it."""
    return (hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)


def short_key(hashes: np.ndarray, n: int) -> np.ndarray:
    """Range and last 32 bits in one number: what a hash sent as 4 bytes to its range amounts to."""
    return (range_of(hashes, n) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def shortened(table: pa.Table) -> pa.Table:
    """The packed rows with 4 bytes per hash."""
    short = [np.frombuffer(x.as_buffer(), np.uint64).astype(np.uint32).tobytes() for x in table.column("hashes")]
    return table.set_column(table.schema.get_field_index("hashes"), "hashes", pa.array(short, pa.binary()))


def body_of(row: pa.Table | pa.RecordBatch, i: int = 0) -> tuple[list, np.ndarray, np.ndarray]:
    """Ids, bytes and n + 1 offsets of the chunk in row ``i``."""
    ids = row.column("ids")[i].as_py() or []
    sizes = np.array(row.column("sizes")[i].as_py() or [], np.int64)
    body = row.column("body")[i].as_buffer()
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return ids, data, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def cut(hashes: np.ndarray, n: int) -> np.ndarray:
    """n + 1 places at which sorted 64-bit hashes pass from one range to the next."""
    edges = ((np.arange(1, n, dtype=np.uint64) << np.uint64(32)) + np.uint64(n - 1)) // np.uint64(n)
    inner = np.searchsorted(hashes >> np.uint64(32), edges)
    return np.concatenate(([0], inner, [len(hashes)]))


def packed_rows(chunk: int, n: int, hashes: np.ndarray, **payload: np.ndarray) -> pa.Table:
    """Rows (range, chunk, hashes, payload..) of the ranges with at least one of the sorted hashes."""
    at = cut(hashes, n)
    full = np.flatnonzero(np.diff(at))
    parts = {"hashes": hashes, **payload}
    columns = [pa.array(full, pa.int64()), pa.array(np.full(len(full), chunk), pa.int64())]
    for values in parts.values():
        columns.append(pa.array([values[at[p] : at[p + 1]].tobytes() for p in full], pa.binary()))
    return pa.Table.from_arrays(columns, ["range", "chunk", *parts])


def unpack(table: pa.Table, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a packed column, and the row each came from."""
    parts = [np.frombuffer(x, kind) if x is not None else np.zeros(0, kind) for x in (v.as_buffer() for v in table.column(name))]
    if not parts:
        return np.zeros(0, kind), np.zeros(0, np.int64)
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(x) for x in parts])


def per_row(table: pa.Table, rows: np.ndarray, values: np.ndarray, name: str) -> pa.Table:
    """Rows (chunk, name): for each row of ``table`` with values, its chunk and these values packed."""
    order = np.argsort(rows, kind="stable")
    rows, values = rows[order], values[order]
    full, at = np.unique(rows, return_index=True)
    at = np.append(at, len(rows))
    chunk = table.column("chunk").to_numpy()[full] if len(full) else np.zeros(0, np.int64)
    blobs = [values[at[i] : at[i + 1]].tobytes() for i in range(len(full))]
    return pa.Table.from_arrays([pa.array(chunk, pa.int64()), pa.array(blobs, pa.binary())], ["chunk", name])


def beside(chunks: DataFrame, answers: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``function`` on each chunk and the answers to it (perhaps none)."""

    def called(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:  # an answer to no chunk cannot be
            raise ValueError("an answer without its chunk")
        return function(left, right)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(called, schema)
