"""Exact deduplication over an extendible-hash index on shared files.

Entries ``(key, text, ids)`` are written once to the shared folder, copies inside one batch already
joined. The directory starts with one pointer per expected bucket; buckets that hold more distinct keys than their
capacity are split by one more bit of the key until none is overfull, which doubles the directory where
needed. Owner tasks take ranges of buckets in key order, chain the texts that share a key and compare their bytes.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import new_dir

#: Distinct keys a bucket holds before it is split.
CAPACITY = 2048


def _entries(batches):
    for batch in batches:
        held: dict[bytes, list] = {}
        for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            # bytes.lower() changes A-Z only
            held.setdefault((body.as_py() or b"").lower(), []).append(doc)
        digests = [hashlib.sha256(body).digest() for body in held]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int.from_bytes(d[:8], "big", signed=True) for d in digests], pa.int64()),
                pa.array([d.hex() for d in digests]),
                pa.array(list(held), pa.binary()),
                pa.array(list(held.values()), pa.list_(pa.int64())),
            ],
            ["key", "sha", "body", "ids"],
        )


def _cell(depth: int):
    """The first bits of the key, as the number of a directory pointer."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Pointers ``(cell, bucket, depth)`` and the number of bits they read.

    ``bucket`` is the first cell that points to the bucket, so buckets are numbered in key order.
    """
    spark = entries.sparkSession
    path = new_dir(spark, "extendible-keys")
    entries.select("key").distinct().write.parquet(path)
    keys = spark.read.parquet(path)
    depth = max(0, math.ceil(math.log2(max(1, keys.count()) / capacity)))
    levels, rest = [], keys
    while True:
        filled = rest.groupBy(_cell(depth).alias("cell")).agg(F.count("*").alias("n"))
        levels.append((depth, filled.filter(F.col("n") <= capacity)))
        overfull = filled.filter(F.col("n") > capacity).select("cell")
        if overfull.isEmpty():
            break
        rest = rest.join(overfull, _cell(depth) == overfull["cell"], "left_semi")
        depth += 1
    pointers = None
    for bits, buckets in levels:
        spread = 1 << (depth - bits)
        level = buckets.select(
            F.explode(F.sequence(F.col("cell") * spread, F.col("cell") * spread + (spread - 1))).alias("cell"),
            (F.col("cell") * spread).alias("bucket"),
            F.lit(bits).alias("depth"),
        )
        pointers = level if pointers is None else pointers.union(level)
    path = new_dir(spark, "extendible-directory")
    pointers.write.parquet(path)
    return spark.read.parquet(path), depth


def _owners(batches):
    """Chains of the texts under one key, over rows ordered by bucket and key."""
    key, chain, size = None, [], 0

    def closed():
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key] * len(chain), pa.int64()),
                pa.array([link[1] for link in chain], pa.string()),
                pa.array([link[2] for link in chain], pa.int64()),
                pa.array([link[3] for link in chain], pa.int64()),
            ],
            ["key", "sha", "keep_id", "group_size"],
        )

    done = []
    for batch in batches:
        columns = [batch.column(name) for name in ("key", "sha", "body", "largest", "n")]
        for i in range(batch.num_rows):
            own, sha, body, largest, n = (c[i].as_py() for c in columns)
            if own != key:
                if chain:
                    done.append(closed())
                key, chain = own, []
            for link in chain:
                if link[0] == body:
                    link[2] = max((x for x in (link[2], largest) if x is not None), default=None)
                    link[3] += n
                    break
            else:
                chain.append([body, sha, largest, n])
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
            done = []
    if chain:
        yield closed()


def dedup(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes agree after lower-casing A-Z; null counts as empty. Of equal texts the row with
    the largest id stays. Rows that repeat the largest id all stay. A null id never stays while its group has another;
    a group of null ids has a null ``keep_id`` and stays whole. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = new_dir(spark, "extendible-entries")
    (
        docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
        .mapInArrow(_entries, "key long, sha string, body binary, ids array<long>")
        .write.option("compression", "zstd")
        .parquet(path)
    )
    entries = spark.read.parquet(path)
    pointers, bits = directory(entries, capacity)
    placed = entries.select(
        "key", "sha", "body", F.array_max("ids").alias("largest"), F.size("ids").cast("long").alias("n"), _cell(bits).alias("cell")
    ).join(pointers.select("cell", "bucket"), "cell")
    groups = (
        placed.repartitionByRange("bucket", "key")
        .sortWithinPartitions("bucket", "key")
        .select("key", "sha", "body", "largest", "n")
        .mapInArrow(_owners, "key long, sha string, keep_id long, group_size long")
    )
    # a hot text is one entry per batch here, not one per document
    return (
        entries.select("key", "sha", "ids")
        .join(groups, ["key", "sha"])
        .select(F.explode("ids").alias("doc_id"), "keep_id", "group_size", F.col("sha").alias("text_sha256"))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
            "text_sha256",
        )
    )
