"""Models that learn batch by batch. A gradient or a set of cluster sums is one
distributed aggregate per batch; what travels to the driver is the small model,
which is stored under its batch number so a repeated batch starts from the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.functions.vectors import squared_distance
from millrace.sinks.files import BatchFn, batch_dir


def _stored(spark: SparkSession, path: str, batch_id: int) -> list[Row]:
    return spark.read.parquet(batch_dir(path, batch_id)).collect()


def margin(cols: Sequence[str], weights: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for c, w in zip(cols, weights):
        total = total + F.col(c) * F.lit(float(w))
    return total


def predict_linear(df: DataFrame, cols: Sequence[str], weights: Sequence[float]) -> DataFrame:
    return df.withColumn("prediction", margin(cols, weights))


def predict_logistic(df: DataFrame, cols: Sequence[str], weights: Sequence[float]) -> DataFrame:
    return df.withColumn("prediction", F.when(margin(cols, weights) > 0, 1.0).otherwise(0.0))


def sgd_step(df: DataFrame, label: str, cols: Sequence[str], weights: Sequence[float], step: float, logistic: bool) -> DataFrame:
    """One row of weights after one gradient step over the whole batch; an empty batch changes nothing."""
    response = margin(cols, weights)
    if logistic:
        response = 1 / (1 + F.exp(-response))
    miss = response - F.col(label)
    moved = [
        (F.lit(float(w)) - F.lit(step) * F.coalesce(F.avg(miss * F.col(c)), F.lit(0.0))).alias(c)
        for c, w in zip(cols, weights)
    ]
    return df.agg(*moved)


def _parts(df: DataFrame, held_out: str | None) -> tuple[DataFrame, DataFrame]:
    """Training and test part of a batch by an SQL condition; where it is null the row trains."""
    if held_out is None:
        return df, df.limit(0)
    flag = F.coalesce(F.expr(held_out), F.lit(False))
    return df.where(~flag), df.where(flag)


def train_sgd(
    path: str, label: str, cols: Sequence[str], step: float = 0.0001, logistic: bool = False, held_out: str | None = None
) -> BatchFn:
    """Weights start at zero, one gradient step per batch, no intercept. Logistic labels are 0 and 1.

    A batch trains on its rows that are not ``held_out`` and then predicts the others. Stored in ``path`` after each batch:
    the weights, the number of test rows ``n_test`` and their mean squared error ``mse`` (null without test rows).
    """
    predict = predict_logistic if logistic else predict_linear

    def learn(df: DataFrame, batch_id: int) -> None:
        weights = [0.0] * len(cols)
        if batch_id > 0:
            (row,) = _stored(df.sparkSession, path, batch_id - 1)
            weights = [row[c] for c in cols]
        train, test = _parts(df, held_out)
        after = [float(x) for x in sgd_step(train, label, cols, weights, step, logistic).first()]
        miss = F.pow(F.col("prediction") - F.col(label), 2)
        score = predict(test, cols, after).agg(F.count(F.lit(1)).alias("n_test"), F.avg(miss).alias("mse"))
        model = score.select(*[F.lit(w).alias(c) for c, w in zip(cols, after)], "n_test", "mse")
        model.write.mode("overwrite").parquet(batch_dir(path, batch_id))

    return learn


def assign(df: DataFrame, features: str, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Number of the nearest centre in column ``cluster``; of equally near ones the first."""
    distances = F.array(
        *[
            squared_distance(F.col(features), F.array(*[F.lit(float(x)) for x in center]))
            for center in centers
        ]
    )
    nearest = F.array_position(F.col("_d"), F.array_min("_d")) - 1
    return df.withColumn("_d", distances).withColumn("cluster", nearest.cast("int")).drop("_d")


def kmeans_step(df: DataFrame, features: str, centers: Sequence[Sequence[float]], weights: Sequence[float], decay: float) -> list[tuple[list[float], float]]:
    """New ``(centre, weight)`` pairs: ``(c·n·decay + Σx) / (n·decay + m)``. With decay 0 only this
    batch counts; a cluster without rows keeps its centre."""
    size = len(centers[0])
    sums = [F.sum(F.get(features, F.lit(i))).alias(f"s{i}") for i in range(size)]
    totals = assign(df, features, centers).groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), *sums)
    by_cluster = {row["cluster"]: row for row in totals.collect()}  # one row per centre
    updated = []
    for number, (center, n) in enumerate(zip(centers, weights)):
        row, kept = by_cluster.get(number), n * decay
        if row is None:
            updated.append((list(center), kept))
            continue
        mass = kept + row["m"]
        updated.append(([(c * kept + row[f"s{i}"]) / mass for i, c in enumerate(center)], mass))
    return updated


def train_kmeans(
    path: str, features: str, centers: Sequence[Sequence[float]], decay: float = 0.0, held_out: str | None = None
) -> BatchFn:
    """A batch moves the centres by its rows that are not ``held_out`` and then assigns the others. Stored in ``path`` after
    each batch: ``(cluster, center, weight, n_test)``, the last the test rows nearest to the centre."""

    def learn(df: DataFrame, batch_id: int) -> None:
        now, weights = [list(c) for c in centers], [0.0] * len(centers)
        if batch_id > 0:
            rows = sorted(_stored(df.sparkSession, path, batch_id - 1), key=lambda r: r["cluster"])
            now, weights = [r["center"] for r in rows], [r["weight"] for r in rows]
        train, test = _parts(df, held_out)
        updated = kmeans_step(train, features, now, weights, decay)
        placed = assign(test, features, [center for center, _ in updated]).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
        n_test = {row["cluster"]: row["n"] for row in placed.collect()}  # one row per centre
        model = [(i, center, weight, n_test.get(i, 0)) for i, (center, weight) in enumerate(updated)]
        df.sparkSession.createDataFrame(
            model, "cluster int, center array<double>, weight double, n_test long"
        ).write.mode("overwrite").parquet(batch_dir(path, batch_id))

    return learn
