"""Random forests of few columns, grown from sums per cell.

A tree only ever asks in which bin a value lies, so all it needs of the rows is the number, the sum and the sum of squares of the labels in each
cell, that is each combination of bins, under its own bootstrap. One pass over the rows gives these sums for all trees of a forest; the trees are
then grown whole, one task each, where MLlib goes over all rows once per level and holds a count per row and tree.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, __version__
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from millrace.scratch import new_dir

#: Cells up to which their sums are held; a forest with more is MLlib's.
CELLS = 1 << 15
#: Trees whose sums a task holds at a time, rows that are sorted by cell together, and rows whose bootstrap counts are held.
TREES_AT_ONCE, BLOCK, DRAWN = 128, 1 << 18, 1 << 13

_CHANCES = [math.exp(-1) / math.factorial(k) for k in range(20)]
_SLOTS = np.floor(np.array(_CHANCES) * 65536).astype(int)
_REST = np.array(_CHANCES) * 65536 - _SLOTS
_COUNTS = np.concatenate((np.repeat(np.arange(20.0), _SLOTS), np.zeros(65536 - _SLOTS.sum())))


def poisson(draw: np.random.Generator, n: int) -> np.ndarray:
    """Poisson numbers of mean 1: whole slots of 16 random bits each, and what is left over of the chances in the last few slots."""
    slot = draw.integers(0, 65536, n, np.uint16)
    out = _COUNTS[slot]
    rest = np.flatnonzero(slot >= _SLOTS.sum())
    out[rest] = draw.choice(20, len(rest), p=_REST / _REST.sum())
    return out


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Splits of a continuous column as MLlib has them: between all values if they are few, else at even strides of the rows."""
    found, counts = np.unique(values, return_counts=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) < bins:
        return between
    stride = target = len(values) / bins
    out, upto = [], np.cumsum(counts)
    for i in range(1, len(found)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


def _binned(batch: pa.RecordBatch, splits: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The cell of every row, and its label."""
    label, values = batch.column(0), batch.column(1)
    if label.null_count or values.null_count:
        raise ValueError("labels and features must not be null")
    label, rows = label.to_numpy(), values.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(splits))
    if not (np.isfinite(rows).all() and np.isfinite(label).all()):
        raise ValueError("labels and features must be finite")
    cell = np.zeros(len(label), np.int64)
    for j in reversed(range(len(splits))):
        cell = cell * (len(splits[j]) + 1) + np.searchsorted(splits[j], rows[:, j])
    return cell, label


def _blocks(batches, splits: Sequence[np.ndarray]):
    """Rows in blocks sorted by cell: cells, and ones, labels and their squares."""
    held, n = [], 0

    def block():
        cell, label = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(cell, kind="stable")
        cell, label = cell[order], label[order]
        return cell, np.stack([np.ones(len(label)), label, label * label])

    for batch in batches:
        if batch.num_rows:
            held.append(_binned(batch, splits))
            n += batch.num_rows
        if n >= BLOCK:
            yield block()
            held, n = [], 0
    if held:
        yield block()


def _starts(cell: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))


def _summed(splits: Sequence[np.ndarray], trees: range, seed: int, bootstrap: bool):
    """Sums of every tree's bootstrap by cell: one row per task and tree."""

    def sums(batches):
        part = TaskContext.get().partitionId()
        draw = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFFFFFFFFFF, part, trees.start]))
        total = {}
        for cell, values in _blocks(batches, splits):
            for at in range(0, len(cell), DRAWN):
                some, number = cell[at : at + DRAWN], values[:, at : at + DRAWN]
                n = len(some) * len(trees)
                weights = (poisson(draw, n) if bootstrap else np.ones(n)).reshape(len(some), -1)
                cuts = [*_starts(some), len(some)]
                for a, b in zip(cuts, cuts[1:]):
                    found = number[:, a:b] @ weights[a:b]
                    key = int(some[a])
                    total[key] = total[key] + found if key in total else found
        if total:
            cells = np.array(sorted(total))
            held = np.stack([total[c] for c in cells], 1)
            packed = [pa.array([np.ascontiguousarray(held[:, :, i]).tobytes() for i in range(len(trees))], pa.binary())]
            one = [pa.array([*trees], pa.int32()), pa.array([part] * len(trees), pa.int32()), pa.array([cells.tobytes()] * len(trees), pa.binary())]
            yield pa.RecordBatch.from_arrays([*one, *packed], ["tree", "part", "cells", "sums"])

    return sums


def _by_cell(splits: Sequence[np.ndarray]):
    """Cells with the number, sum and sum of squares of their labels."""

    def sums(batches):
        for cell, values in _blocks(batches, splits):
            at = _starts(cell)
            found = np.add.reduceat(values, at, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(cell[at]), *(pa.array(x) for x in found)], ["cell", "n", "s", "q"])

    return sums


def _variance(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    n = np.maximum(n, 1)
    return (q - s * s / n) / n


def bins_of(cells: np.ndarray, splits: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every cell in every column."""
    out = []
    for s in splits:
        out.append(cells % (len(s) + 1))
        cells = cells // (len(s) + 1)
    return np.stack(out, 1)


def grow(bins: np.ndarray, sums: np.ndarray, splits: Sequence[np.ndarray], pick: Callable[[], np.ndarray], depth: int, least: int, gain: float) -> list[tuple]:
    """Nodes ``(number, sum, sum of squares, variance, gain, column, split, left, right)`` of one tree, each before its children; a leaf's column is -1.

    ``pick`` draws the columns that a node may split by.
    """
    nodes = []

    def add(some: np.ndarray, level: int) -> None:
        me, (n, s, q) = len(nodes), sums[:, some].sum(1)
        own = float(_variance(n, s, q))
        nodes.append((n, s, q, own, -1.0, -1, -1, -1, -1))
        if level == depth or n == 0 or (level and abs(own) < 2.3e-16):
            return
        best = (-math.inf, -1, -1)
        for j in pick():
            if len(splits[j]):
                left = np.stack([np.bincount(bins[some, j], x, len(splits[j]) + 1) for x in sums[:, some]]).cumsum(1)[:, :-1]
                right = sums[:, some].sum(1)[:, None] - left
                gains = own - left[0] / n * _variance(*left) - right[0] / n * _variance(*right)
                gains[(left[0] < least) | (right[0] < least) | (gains < gain)] = -math.inf
                at = int(np.argmax(gains))
                if gains[at] > best[0]:
                    best = (float(gains[at]), int(j), at)
        if best[0] <= 0:
            return
        _, j, at = best
        lower = bins[some, j] <= at
        add(some[lower], level + 1)
        right = len(nodes)
        add(some[~lower], level + 1)
        a, b = nodes[me + 1], nodes[right]
        if right == me + 2 and right == len(nodes) - 1 and a[5] == b[5] == -1 and _prediction(a) == _prediction(b):
            del nodes[me + 1 :]  # as MLlib does: two leaves that say the same are one
        else:
            nodes[me] = (n, s, q, own, *best, me + 1, right)

    add(np.arange(len(bins)), 0)
    return nodes


def _prediction(node: tuple) -> float:
    return node[1] / node[0] if node[0] else 0.0


def _grown(splits: Sequence[np.ndarray], columns: int, seed: int, depth: int, least: int, gain: float):
    def grown(key: tuple, table: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        table = table.sort_by("part")
        cells = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table.column("cells")])
        parts = np.concatenate([np.frombuffer(x.as_buffer()).reshape(3, -1) for x in table.column("sums")], 1)
        cells, which = np.unique(cells, return_inverse=True)
        sums = np.stack([np.bincount(which, x, len(cells)) for x in parts])
        draw = np.random.default_rng([seed & 0xFFFFFFFFFFFFFFFF, tree])
        pick = lambda: np.sort(draw.choice(len(splits), columns, replace=False))
        nodes = np.array(grow(bins_of(cells, splits), sums, splits, pick, depth, least, gain))
        return pa.table({"tree": pa.array([tree], pa.int32()), "nodes": pa.array([nodes.tobytes()], pa.binary())})

    return grown


def _points(rows: DataFrame, label: str, features: str) -> DataFrame:
    """Labels, and vectors (or arrays) as arrays."""
    values = F.col(features) if isinstance(rows.schema[features].dataType, ArrayType) else vector_to_array(features)
    return rows.select(F.col(label).cast("double").alias("label"), values.alias("features"))


class CellForest(RandomForestRegressor):
    """MLlib's random forest on rows of few columns: the same bins, bootstrap, choice of columns and splits, in one pass over the rows.

    The fit gives a ``GrownForest``; features may be arrays too. Where the combinations of bins are more than ``CELLS``, or settings ask for more, MLlib fits its own model.
    """

    def _fit_java(self, dataset: DataFrame):
        rows = _points(dataset, self.getLabelCol(), self.getFeaturesCol())
        head = rows.select(F.size("features")).head()
        width = head[0] if head else 0
        if width < 1 or not cells_fit(width, self.getMaxBins()) or not self._usual():
            return super()._fit_java(dataset)
        n, seed, wanted = rows.count(), self.getSeed(), max(self.getMaxBins() ** 2, 10_000)
        seen = rows.select("features") if n <= wanted else rows.select("features").sample(wanted / n, seed)
        seen = np.array([r[0] for r in seen.collect()], float).reshape(-1, width)
        bins = min(self.getMaxBins(), n)
        splits = [thresholds(column, bins) for column in seen.T]
        trees, strategy = self.getNumTrees(), self.getFeatureSubsetStrategy()
        columns = width if strategy == "all" or (strategy == "auto" and trees == 1) else math.ceil(width / 3)
        found = []
        for first in range(0, trees, TREES_AT_ONCE):
            some = range(first, min(first + TREES_AT_ONCE, trees))
            sums = rows.mapInArrow(_summed(splits, some, seed, self.getBootstrap()), "tree int, part int, cells binary, sums binary")
            grower = _grown(splits, columns, seed, self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain())
            found += sums.groupBy("tree").applyInArrow(grower, "tree int, nodes binary").collect()
        nodes = [np.frombuffer(r.nodes).reshape(-1, 9) for r in sorted(found)]
        params = {p.name: v for p, v in self.extractParamMap().items()}
        return GrownForest(splits, nodes, params)

    def _usual(self) -> bool:
        usual = self.getFeatureSubsetStrategy() in ("auto", "all", "onethird") and self.getMinWeightFractionPerNode() == 0
        return usual and not self.isDefined("weightCol") and (self.getSubsamplingRate() == 1 or not self.getBootstrap())

    def _create_model(self, found):
        return found if isinstance(found, GrownForest) else super()._create_model(found)


def cells_fit(columns: int, bins: int = 32) -> bool:
    """Whether the combinations of so many columns' bins are few."""
    return bins**columns <= CELLS


class GrownForest(Model):
    """Trees on cells; ``mllib`` is the same forest as MLlib's model."""

    def __init__(self, splits: Sequence[np.ndarray], nodes: Sequence[np.ndarray], params: dict):
        super().__init__()
        self.splits, self.nodes, self.of = splits, nodes, params

    def predictions(self, cells: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
        """What the first trees of each of the ascending ``sizes`` predict for each cell."""
        bins, total, out = bins_of(cells, self.splits), np.zeros(len(cells)), []
        for i, nodes in enumerate(self.nodes):
            at = np.zeros(len(cells), int)
            while (inner := np.flatnonzero(nodes[at, 5] >= 0)).size:
                node = nodes[at[inner]]
                lower = bins[inner, node[:, 5].astype(int)] <= node[:, 6]
                at[inner] = np.where(lower, node[:, 7], node[:, 8]).astype(int)
            total += nodes[at, 1] / np.maximum(nodes[at, 0], 1)
            if i + 1 in sizes:
                out.append(total / (i + 1))
        return out

    def squared_errors(self, rows: DataFrame, sizes: Sequence[int]) -> tuple[int, list[float]]:
        """Rows, and the sum of squared errors of the first trees of every size, from one pass over the rows."""
        taken = _points(rows, self.of["labelCol"], self.of["featuresCol"])
        sums = taken.mapInArrow(_by_cell(self.splits), "cell long, n double, s double, q double")
        found = np.array([tuple(r) for r in sums.groupBy("cell").agg(F.sum("n"), F.sum("s"), F.sum("q")).collect()], float).reshape(-1, 4)
        n, s, q = found[:, 1:].T
        told = self.predictions(found[:, 0].astype(np.int64), sizes)
        return int(n.sum()), [max(float((q - 2 * x * s + n * x * x).sum()), 0.0) for x in told]

    def mllib(self, spark: SparkSession) -> RandomForestRegressionModel:
        """Written in MLlib's format and read back."""
        path, kind = new_dir(spark, "forest"), "org.apache.spark.ml.regression.RandomForestRegressionModel"
        about = {"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": __version__, "uid": f"rfr_{self.uid.rpartition('_')[2]}"}
        about |= {"paramMap": self.of, "defaultParamMap": {}, "numFeatures": len(self.splits), "numTrees": len(self.nodes)}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        each = {"class": kind.replace("RandomForest", "DecisionTree"), "timestamp": about["timestamp"], "sparkVersion": __version__}
        each |= {"paramMap": {}, "defaultParamMap": {}, "numFeatures": len(self.splits)}
        trees = [(i, json.dumps(each | {"uid": f"dtr_{self.uid.rpartition('_')[2]}_{i}"}), 1.0) for i in range(len(self.nodes))]
        spark.createDataFrame(trees, "treeID int, metadata string, weights double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        rows = []
        for i, nodes in enumerate(self.nodes):
            for k, node in enumerate(nodes.tolist()):
                n, s, q, own, gain, column, at, left, right = node
                split = (int(column), [float(self.splits[int(column)][int(at)])] if column >= 0 else [], -1)
                rows.append((i, (k, _prediction(node), own, [n, s, q], int(n), gain, int(left), int(right), split)))
        split = "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
        node = "id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: long, gain: double"
        schema = f"treeID int, nodeData struct<{node}, leftChild: int, rightChild: int, {split}>"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/data")
        return RandomForestRegressionModel.load(path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.mllib(dataset.sparkSession).transform(dataset)
