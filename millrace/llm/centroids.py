"""Centroid clustering of integer vectors with a vantage-point tree over the centroids.

Vectors are packed once into blocks on shared storage. Every round grows a tree over the centroids, broadcasts it (its size is
the number of centroids times the width) and scans the blocks: each vector searches best first, always opening
the node with the least bound, until every bound lies beyond its best distance. A bound equal to the best distance is opened too, since
a smaller number may tie. Distances are exact integers. Blocks walk in step: the vectors of a block that open the same
node are compared with it at once. Tasks send back one sum per centroid and dimension.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import vectors as V
from millrace.scratch import new_dir

SCALE, WIDTH, CENTROIDS, ROUNDS = 1024, 64, 8, 10
#: Centroids in a leaf at most, and bounds held at once while a block is searched.
LEAF, HELD = 4, 4 << 20


def limit(width: int) -> int:
    """Integers within this bound have squared distances that fit a long."""
    return math.isqrt(((1 << 63) - 1) // max(1, width)) // 2


def grow(points: np.ndarray) -> dict[str, np.ndarray]:
    """The tree in arrays: of every node the vantage point (-1: a leaf), both children with the least and the largest distance of
    their points from it, and the range of a leaf in ``order``.

    The points beside the vantage point are halved in order of distance, so equal points cannot unbalance it.
    """
    nodes, order = [], []
    waiting = [(np.arange(len(points)), None, None)]
    while waiting:
        inside, parent, side = waiting.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent][side] = at
        if len(inside) <= LEAF:
            nodes.append({"vantage": -1, "near": -1, "far": -1, "spans": (0.0, 0.0, 0.0, 0.0), "first": len(order), "end": len(order) + len(inside)})
            order += inside.tolist()
            continue
        # the point farthest from another one sees the rest at most different distances
        vantage = inside[int(((points[inside] - points[inside[0]]) ** 2).sum(axis=1).argmax())]
        rest = inside[inside != vantage]
        distance = ((points[rest] - points[vantage]) ** 2).sum(axis=1)
        by = np.lexsort((rest, distance))
        rest, distance, half = rest[by], np.sqrt(distance[by].astype(float)), len(rest) // 2
        spans = (distance[0], distance[half - 1], distance[half], distance[-1])
        nodes.append({"vantage": int(vantage), "near": -1, "far": -1, "spans": spans, "first": 0, "end": 0})
        waiting += [(rest[half:], at, "far"), (rest[:half], at, "near")]
    column = lambda name, kind: np.array([node[name] for node in nodes], kind)
    numbers = {name: column(name, np.int64) for name in ("vantage", "near", "far", "first", "end")}
    return {**numbers, "spans": column("spans", float), "order": np.array(order, np.int64), "points": points}


def nearest(tree: dict[str, np.ndarray], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest point of every row, the smallest number of equally near ones, and the squared distance."""
    step = max(1, HELD // len(tree["vantage"]))
    parts = [_nearest(tree, matrix[first : first + step].astype(np.int64)) for first in range(0, len(matrix), step)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _nearest(tree: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    points = tree["points"]
    best, number = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(points))
    bounds = np.full((len(x), len(tree["vantage"])), np.inf)
    bounds[:, 0] = 0

    def compare(rows: np.ndarray, point: int) -> np.ndarray:
        distance = ((x[rows] - points[point]) ** 2).sum(axis=1)
        closer = (distance < best[rows]) | ((distance == best[rows]) & (point < number[rows]))
        best[rows[closer]], number[rows[closer]] = distance[closer], point
        return distance

    rows = np.arange(len(x))
    while len(rows):
        opened = bounds[rows].argmin(axis=1)
        # the radius is inclusive, and wider than any rounding of the bounds
        within = bounds[rows, opened] <= np.sqrt(best[rows].astype(float)) * (1 + 1e-9) + 1e-6
        rows, opened = rows[within], opened[within]
        for node in np.unique(opened):
            own = rows[opened == node]
            bound = bounds[own, node]
            bounds[own, node] = np.inf
            if tree["vantage"][node] < 0:
                for point in tree["order"][tree["first"][node] : tree["end"][node]]:
                    compare(own, int(point))
                continue
            far = np.sqrt(compare(own, int(tree["vantage"][node])).astype(float))
            near_low, near_high, far_low, far_high = tree["spans"][node]
            bounds[own, tree["near"][node]] = np.maximum(bound, np.maximum(near_low - far, far - near_high))
            bounds[own, tree["far"][node]] = np.maximum(bound, np.maximum(far_low - far, far - far_high))
    return number, best


def _packed(df: DataFrame, scale: int, width: int, id_col: str, vector_col: str) -> DataFrame:
    kind, most = df.schema[id_col].dataType.simpleString(), limit(width)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, matrix = V.integers(batch.column(1), width, scale, most)
            yield from V.blocks(matrix, batch.column(0).take(pa.array(kept)))

    path = new_dir(df.sparkSession, "centroids-blocks")
    df.select(id_col, vector_col).mapInArrow(packed, f"{V.BLOCK_SCHEMA}, ids array<{kind}>").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def first_centroids(df: DataFrame, k: int, seed: str, scale: int, width: int, id_col: str, vector_col: str) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id; those of equal ids by their entries."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    kept = df.where(V.usable(vector_col) & (F.size(vector_col) == width)).select(F.sha2(text, 256).alias("h"), F.col(vector_col).alias("v"))
    chosen = [row["v"] for row in kept.orderBy("h", "v").limit(k).collect()]
    return V.integers(pa.array(chosen, pa.list_(pa.float64())), width, scale, limit(width))[1]


def _totals(blocks: DataFrame, points: np.ndarray) -> tuple[np.ndarray, list[int], list[list[int]]]:
    """Members, summed distance and summed entries of every centroid, exactly."""
    k, width, context = len(points), points.shape[1], blocks.sparkSession.sparkContext
    tree = context.broadcast(grow(points))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # distances are summed in two halves of their bits, so that a task's sums fit
        sums = np.zeros((k, width + 3), np.int64)
        for matrix, _ in V.matrices(batches):
            number, distance = nearest(tree.value, matrix)
            order = np.argsort(number, kind="stable")
            full, at = np.unique(number[order], return_index=True)
            facts = np.column_stack((np.ones(len(matrix), np.int64), distance >> 32, distance & 0xFFFFFFFF, matrix))
            sums[full] += np.add.reduceat(facts[order], at, axis=0) if len(full) else 0
        full = np.flatnonzero(sums[:, 0])
        columns = [np.repeat(full, width + 3), np.tile(np.arange(width + 3), len(full)), sums[full].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64()))], ["c", "place", "value"])

    summed = blocks.mapInArrow(per_task, "c int, place int, value long").groupBy("c", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out = [[0] * (width + 3) for _ in range(k)]
    for c, place, value in summed.collect():
        out[c][place] = int(value)
    tree.unpersist()
    return np.array([row[0] for row in out]), [(row[1] << 32) + row[2] for row in out], [row[3:] for row in out]


def cluster(
    df: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    width: int = WIDTH,
    seed: str = "3",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector of ``width`` finite entries: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Other rows are left out. A null id hashes as the empty text; ids may repeat. With fewer vectors than ``k`` there are fewer
    centroids, two of which may be equal: the smaller number wins every tie and the other one stays where it is. An entry so large that
    squared distances would not fit a long (beyond 185,000 for 64 entries) is read as the largest that does. ``k`` bounds what
    is broadcast and collected. An empty table gives no rows.
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    points = first_centroids(df, k, seed, scale, width, id_col, vector_col)
    if not len(points):
        return df.sparkSession.createDataFrame([], schema)
    blocks = _packed(df, scale, width, id_col, vector_col)
    for _ in range(rounds):
        members, _, sums = _totals(blocks, points)
        moved = [[s // int(n) for s in row] if n else old for n, row, old in zip(members, sums, points.tolist())]
        if moved == points.tolist():  # further rounds would change nothing
            break
        points = np.array(moved, np.int64)
    _, spread, _ = _totals(blocks, points)
    tree = df.sparkSession.sparkContext.broadcast(grow(points))
    digests = pa.array([hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in points.tolist()])
    own, whole = np.array(spread, np.int64), sum(spread)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matrix, ids in V.matrices(batches):
            number, distance = nearest(tree.value, matrix)
            columns = [
                ids, pa.array(number, pa.int32()), pa.array(distance), pa.array(own[number]),
                pa.array(np.full(len(number), whole), pa.int64()), digests.take(pa.array(number)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return blocks.mapInArrow(rows, schema)
