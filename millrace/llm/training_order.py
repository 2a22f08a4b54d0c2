"""Token ids in training order: fixed-stride shards under a keyed permutation.

1. Documents become token ids, each followed by the end token, stored once in chunks (a bucketed table).
2. Sums over chunks give every chunk its place in one long stream, cut into sequences of ``length`` tokens.
3. A keyed Feistel network permutes sequence numbers; numbers it sends beyond the last sequence walk on until they fall
   inside (cycle-walking), so slots are a permutation of 0 .. n - 1 computable, and invertible, anywhere.
4. One exchange by slot range, of what each chunk holds of the range, compressed; each range places it and writes one shard: records of ``length`` ids and a closing line feed, in slot order. Slot s
   stands at a fixed byte of a known file, so a reader resumes anywhere and reads on sequentially.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import chunks as C
from millrace.llm import text as T
from millrace.llm import tokens
from millrace.scratch import new_dir

LENGTH = 1024
ROUNDS = 6
#: Bytes of a shard, which a task holds while it places the pieces.
SHARD_BYTES = 64 << 20
#: Bytes of ids in a stored chunk (longer chunks compress better on their way), and the level of that compression.
CHUNK_BYTES, LEVEL = 4 << 20, 5


def permute(numbers: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """Slots of sequence numbers below n, or with ``inverse`` the numbers of slots."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = T.mix(np.uint64(key & (2**63 - 1)) + np.arange(ROUNDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.asarray(numbers, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys[::-1] if inverse else keys:
            if inverse:
                left, right = right ^ (T.mix(left ^ k) & mask), left
            else:
                left, right = right, left ^ (T.mix(right ^ k) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def _encode(vocabulary: bytes, limit: int):
    def encoded(batches):
        coder = tokens.coder(vocabulary)
        end = np.array([coder.end], coder.kind).tobytes()
        number = TaskContext.get().partitionId() << 32
        held, size, docs = [], 0, 0

        def closed():
            body = b"".join(held)
            values = [number], [len(body) // coder.kind.itemsize], [docs], [body]
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["chunk", "n", "docs", "body"])

        for batch in batches:
            for text in batch.column(0):
                held.append(coder.encode(text.as_py() or "") + end)
                size, docs = size + len(held[-1]), docs + 1
                if size >= limit:
                    yield closed()
                    held, size, docs, number = [], 0, 0, number + 1
        if held:
            yield closed()

    return encoded


def _pieces(n: int, shards: int, length: int, key: int, kind: np.dtype):
    """What a chunk holds of each shard, in one row: slots, places within them, sizes and the compressed ids."""

    def cut(batches):
        codec = pa.Codec("zstd", compression_level=LEVEL)
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("body")[i].as_buffer(), kind)
                at = batch.column("at")[i].as_py()
                first = at // length
                edges = np.clip(np.arange(first, (at + len(ids) - 1) // length + 2) * length - at, 0, len(ids))
                slots = permute(np.arange(first, first + len(edges) - 1), n, key)
                places = np.zeros(len(slots), np.int32)
                places[0] = at - first * length
                sizes = np.diff(edges).astype(np.int32)
                shard = slots * shards // n
                order = np.argsort(shard, kind="stable")
                full, begin = np.unique(shard[order], return_index=True)
                rows = np.split(order, begin[1:])
                joined = (np.concatenate([ids[edges[k] : edges[k + 1]] for k in row]).tobytes() for row in rows)
                bodies = [codec.compress(body, asbytes=True) for body in joined]
                packed = lambda values: pa.array([values[row].tobytes() for row in rows], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full), packed(slots), packed(places), packed(sizes), pa.array(bodies, pa.binary())],
                    ["shard", "slots", "places", "sizes", "ids"],
                )

    return cut


def _records(manifest: dict, kind: np.dtype):
    """The records of the one shard that a task holds. Every piece has its place, so nothing is sorted."""
    length = manifest["length"]

    def placed(batches):
        out = None
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    shard = batch.column("shard")[i].as_py()
                    begin, stop = first_slot(shard, manifest), first_slot(shard + 1, manifest)
                    out = np.full((stop - begin) * length, manifest["end"], kind)
                slots, places, sizes = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in (("slots", np.int64), ("places", np.int32), ("sizes", np.int32))
                )
                body = pa.decompress(batch.column("ids")[i].as_buffer(), int(sizes.sum()) * kind.itemsize, "zstd")
                ids, ends = np.frombuffer(body, kind), np.cumsum(sizes)
                for at, low, high in zip((slots - begin) * length + places, ends - sizes, ends):
                    out[at : at + high - low] = ids[low:high]
        if out is not None:
            for low in range(0, len(out), 1024 * length):
                part = out[low : low + 1024 * length].reshape(-1, length)
                yield pa.RecordBatch.from_arrays([pa.array([record.tobytes() for record in part], pa.binary())], ["record"])

    return placed


def materialise(
    docs: DataFrame, path: str, key: int = 20_25, length: int = LENGTH, vocabulary: str = tokens.VOCABULARY, text_col: str = "text"
) -> dict:
    """Write the shards below ``path`` and return their manifest (also stored there).

    A null or empty text is its end token alone; equal rows are written as often as they occur. The last
    sequence is filled with end tokens. An empty table gives a manifest of no sequences and no shard.
    """
    spark = docs.sparkSession
    vocab = tokens.read_vocabulary(vocabulary)
    coder = tokens.coder(vocab)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"token_chunks_{uuid.uuid4().hex}"
    docs.select(F.col(text_col).cast("string")).mapInArrow(
        _encode(vocab, CHUNK_BYTES), "chunk long, n long, docs long, body binary"
    ).write.bucketBy(parts, "chunk").option("compression", "zstd").saveAsTable(name)
    stored = spark.table(name)
    task = F.expr("chunk div 4294967296")
    tasks = stored.groupBy(task.alias("task")).agg(F.sum("n").alias("n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("task", F.coalesce(F.sum("n").over(before(Window.orderBy("task"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n").over(before(Window.partitionBy("task").orderBy("chunk"))), F.lit(0))
    places = stored.select("chunk", "n", task.alias("task")).withColumn("inside", inside).join(bases, "task").select(
        "chunk", (F.col("base") + F.col("inside")).alias("at")
    )
    total = stored.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    n = -(-total[0] // length)
    shards = min(n, max(parts, n * length * coder.kind.itemsize // SHARD_BYTES))
    manifest = {
        "sequences": n, "shards": shards, "length": length, "tokens": total[0], "documents": total[1], "key": key,
        "end": coder.end, "width": coder.kind.itemsize, "stride": length * coder.kind.itemsize + 1,
    }
    spark.createDataFrame([manifest]).coalesce(1).write.json(f"{path}/manifest")
    if n:
        (
            stored.select("chunk", "body")
            .join(places, "chunk")
            .mapInArrow(_pieces(n, shards, length, key, coder.kind), "shard long, slots binary, places binary, sizes binary, ids binary")
            .repartitionById(shards, F.col("shard").cast("int"))
            .mapInArrow(_records(manifest, coder.kind), "record binary")
            .select(F.col("record").cast("string").alias("value"))
            .write.option("lineSep", "\n")
            .text(f"{path}/shards")
        )
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    return spark.read.json(f"{path}/manifest").first().asDict()


def first_slot(shard: int, manifest: dict) -> int:
    """The first slot of a shard; that of shard ``shards`` is the number of sequences."""
    return -(-shard * manifest["sequences"] // manifest["shards"])


def _read(manifest: dict, from_slot: int):
    length, stride, kind = manifest["length"], manifest["stride"], f"<u{manifest['width']}"

    def records(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                body = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                begin = first_slot(shard, manifest)
                if len(body) != first_slot(shard + 1, manifest) - begin or (body[:, -1] != 10).any():
                    raise ValueError(f"shard {shard} is not whole")
                for low in range(max(0, from_slot - begin), len(body), 2048):
                    part = body[low : low + 2048]
                    slots = np.arange(begin + low, begin + low + len(part))
                    seq = permute(slots, manifest["sequences"], manifest["key"], inverse=True)
                    real = np.clip(manifest["tokens"] - seq * length, 0, length)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(slots), pa.array(seq), pa.array([shard] * len(part), pa.int64()),
                            pa.array((slots - begin) * stride), pa.array(real),
                            pa.array([np.ascontiguousarray(r[:-1]).tobytes() for r in part], pa.binary()),
                        ],
                        ["slot", "seq", "shard", "offset", "n_tokens", "ids"],
                    )

    return records


def read(spark: SparkSession, path: str, from_slot: int = 0) -> DataFrame:
    """``slot, seq, shard, offset, n_tokens, ids`` of the records from a slot on; earlier shards are not opened."""
    manifest = read_manifest(spark, path)
    schema = "slot long, seq long, shard long, offset long, n_tokens long, ids binary"
    if not manifest["sequences"]:
        return spark.createDataFrame([], schema)
    skipped = from_slot * manifest["shards"] // manifest["sequences"]
    shard = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    files = spark.read.format("binaryFile").load(f"{path}/shards").withColumn("shard", shard).filter(F.col("shard") >= skipped)
    return files.select("shard", "content").mapInArrow(_read(manifest, from_slot), schema)


def new_path(spark: SparkSession) -> str:
    return new_dir(spark, "training-order")
