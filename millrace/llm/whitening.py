"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The fit list, every distinct integer vector once, lies in packed blocks on shared storage. Step j sends the right vectors
``v_1 .. v_j`` to the tasks, multiplies the centred rows by ``v_j`` (``Xv``), takes off the part along the earlier left vectors, and
sums the products of the result with the rows (``X'u``) and with every earlier left vector. Left vectors are never stored: they are as
long as the corpus, and each task gets those of its rows back from the recurrence, with the same operations. Both sides are
reorthogonalised in full; a direction that comes to an end is followed by a fresh one. The SVD of the small bidiagonal matrix
gives components and deviations. A step is one scan with one number per dimension and step sent back; a lost task is run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import vectors as V
from millrace.scratch import new_dir

SCALE, COMPONENTS = 256, 4
#: Integers stay within this bound, so a sum of them over one task fits a long.
LIMIT = 1 << 31
#: Lengths relative to the whole matrix, and eigenvalues relative to the largest, that count as zero.
NOTHING, FLAT = 1e-13, 1e-12


@dataclass
class Whitening:
    """Components by rows, their eigenvalues and shares of the variance, and the centre as exact sums."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float | None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit_list(df: DataFrame, width: int, scale: int, vector_col: str) -> DataFrame:
    """Blocks of the distinct integer vectors, stored."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, matrix = V.integers(batch.column(0), width, scale, LIMIT, shorter=True)
            yield pa.RecordBatch.from_arrays([V.row_keys(matrix)], ["x"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from V.blocks(V.from_keys(batch.column(0), width))

    path = new_dir(df.sparkSession, "whitening-fit")
    df.select(vector_col).mapInArrow(keys, "x binary").distinct().mapInArrow(packed, V.BLOCK_SCHEMA).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def exact_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1, np.int64)
        for matrix, _ in V.matrices(batches):
            total[0] += len(matrix)
            total[1:] += matrix.sum(axis=0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1), pa.int32()), pa.array(total)], ["place", "value"])

    summed = rows.mapInArrow(per_task, "place int, value long").groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found = {r["place"]: int(r["value"]) for r in summed.collect()}
    return found.get(0, 0), [found.get(k + 1, 0) for k in range(width)]


def sum_over(rows: DataFrame, size: int, function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``function`` over all blocks: added up in each task, then by place."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for matrix, _ in V.matrices(batches):
            total += function(matrix)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["place", "value"])

    out = np.zeros(size)
    for row in rows.mapInArrow(per_task, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[row["place"]] = row["value"]
    return out


@dataclass
class Bidiagonal:
    """``A V = U R`` so far: R is upper bidiagonal but for what reorthogonalising took off."""

    v: list[np.ndarray] = field(default_factory=list)
    along: list[np.ndarray] = field(default_factory=list)  # column j of R above the diagonal
    alpha: list[float] = field(default_factory=list)
    beta: list[float] = field(default_factory=list)

    def matrix(self) -> np.ndarray:
        return np.diag(self.alpha) + np.diag(self.beta[: len(self.alpha) - 1], 1)


def left_vectors(centred: np.ndarray, v: np.ndarray, along: list[np.ndarray], alpha: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Of these rows: the left vectors whose ``alpha`` is known, and the next one, not yet of length 1."""
    products = centred @ v.T
    u = np.zeros((len(centred), len(alpha)))
    for j, a in enumerate(alpha):
        if a:
            u[:, j] = (products[:, j] - u[:, :j] @ along[j]) / a
    return u, products[:, -1] - u @ along[len(alpha)]


def bidiagonalise(rows: DataFrame, mean: np.ndarray, size: float, steps: int, seed: int = 11) -> Bidiagonal:
    """``steps`` steps on the centred rows, whose Frobenius norm is ``size``."""
    width, draw, b, images = len(mean), np.random.default_rng(seed), Bidiagonal(), []

    def fresh() -> np.ndarray:
        return orthogonal(draw.normal(size=width))

    def orthogonal(x: np.ndarray) -> np.ndarray:
        for _ in range(3):
            for v in b.v:
                x = x - (v @ x) * v
        return x

    following = fresh()
    while len(b.v) < steps:
        j = len(b.v)
        b.v.append(following / np.linalg.norm(following))
        right, take = np.array(b.v), np.zeros(j)
        if j:
            take[j - 1] = b.beta[j - 1]
        while True:

            def products(matrix: np.ndarray, along=[*b.along, take], alpha=list(b.alpha)) -> np.ndarray:
                centred = matrix - mean
                u, w = left_vectors(centred, right, along, alpha)
                return np.concatenate(([w @ w], u.T @ w, centred.T @ w))

            found = sum_over(rows, 1 + j + width, products)
            squared, back, image = found[0], found[1 : 1 + j], found[1 + j :]
            rest = squared - back @ back
            take = take + back
            if back @ back <= 1e-20 * squared or squared <= (NOTHING * size) ** 2:
                break
        length = float(np.sqrt(max(rest, 0)))
        length = length if length > NOTHING * size else 0.0
        if length:  # the product of the rows with the left vector, once it is orthogonal to the others
            image = (image - sum((h * x for h, x in zip(back, images)), np.zeros(width))) / length
        else:
            image = np.zeros(width)
        b.along.append(take)
        b.alpha.append(length)
        images.append(image)
        following = orthogonal(image - length * b.v[-1])
        beta = float(np.linalg.norm(following))
        if beta <= NOTHING * size:
            beta, following = 0.0, fresh()
        b.beta.append(beta)
    return b


def fit(df: DataFrame, components: int = COMPONENTS, scale: int = SCALE, steps: int | None = None, vector_col: str = "embedding") -> Whitening | None:
    """The whitening of the distinct vectors; None where there is no vector with entries.

    By default there are as many steps as dimensions, which also finds equal eigenvalues; fewer leave out what the start does not show.
    """
    width = df.where(V.usable(vector_col)).agg(F.max(F.size(vector_col))).first()[0]
    if not width:
        return None
    rows = fit_list(df, width, scale, vector_col)
    n, sums = exact_sums(rows, width)
    mean = np.array([s / n for s in sums])
    squares = float(sum_over(rows, 1, lambda matrix: np.array([((matrix - mean) ** 2).sum()]))[0])
    found = bidiagonalise(rows, mean, float(np.sqrt(squares)), min(width, steps or width))
    _, deviations, turned = np.linalg.svd(found.matrix())
    directions = (turned @ np.array(found.v))[:components]
    largest = np.abs(directions).argmax(axis=1)
    directions *= np.sign(directions[np.arange(len(directions)), largest])[:, None]
    values = deviations[:components] ** 2 / n
    values[values <= FLAT * values[0]] = 0
    out = Whitening(n, sums, directions, values, values * n / squares if squares else np.zeros(len(values)), None)
    out.identity_error = _identity_error(rows, out)
    return out


def _identity_error(rows: DataFrame, found: Whitening) -> float | None:
    """The largest entry of the covariance of the whitened fit list minus the identity, measured in one more scan."""
    real = found.eigenvalues > 0
    if not real.any():
        return None
    mean, turn, k = found.mean, found.components[real].T / np.sqrt(found.eigenvalues[real]), int(real.sum())

    def moments(matrix: np.ndarray) -> np.ndarray:
        z = (matrix - mean) @ turn
        return np.concatenate((z.sum(axis=0), (z.T @ z).ravel()))

    sums = sum_over(rows, k + k * k, moments) / found.n
    covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(matrix: np.ndarray, n: int, sums: list[int]) -> list:
    """``sum((n * x - S)^2)`` of every row, exactly; None beyond 38 digits."""
    most = n * int(np.abs(matrix).max(initial=0)) + max(map(abs, sums))
    if matrix.shape[1] * most**2 < 1 << 63:
        return ((matrix * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    found = ((matrix.astype(object) * n - np.array(sums, object)) ** 2).sum(axis=1)
    return [x if x < 10**38 else None for x in found.tolist()]


def whiten(
    df: DataFrame, components: int = COMPONENTS, scale: int = SCALE, steps: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n, deviation`` (decimal), ``whitened, explained, identity_error``.

    Rows whose vector is null or holds null or non-finite entries are left out; ids may be null or repeat, and repeated
    vectors count once in the fit and each have rows. Vectors shorter than the longest are filled up with 0. An entry beyond
    ``LIMIT / scale`` is read as that. A component without variance has ``explained`` 0 and ``whitened`` null; where no
    component has any (one distinct vector), ``identity_error`` is null too. A deviation beyond 38 digits is null. Empty vectors
    only, and an empty table, give no rows.
    """
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    found = fit(df, components, scale, steps, vector_col)
    if found is None:
        return spark.createDataFrame([], schema)
    k, width = found.components.shape
    turn = found.components.T / np.sqrt(np.where(found.eigenvalues > 0, found.eigenvalues, np.nan))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, matrix = V.integers(batch.column(1), width, scale, LIMIT, shorter=True)
            whitened = ((matrix - found.mean) @ turn).ravel()
            exact = [None if x is None else Decimal(x) for x in _deviations(matrix, found.n, found.sums)]
            each = pa.array(np.repeat(np.arange(len(kept)), k))
            columns = [
                batch.column(0).take(pa.array(kept)).take(each),
                pa.array(np.tile(np.arange(1, k + 1), len(kept)), pa.int32()),
                pa.array(np.full(len(each), found.n), pa.int64()),
                pa.array(exact, pa.decimal128(38, 0)).take(each),
                pa.array(whitened, mask=np.isnan(whitened)),
                pa.array(np.tile(found.explained, len(kept))),
                pa.array([found.identity_error] * len(each), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return df.select(id_col, vector_col).mapInArrow(rows, schema)
