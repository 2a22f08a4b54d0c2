"""Batch models."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import forests


def recommender(ratings: DataFrame, seed: int, rank: int = 10, iterations: int = 10, reg: float = 0.01) -> ALSModel:
    """Alternating least squares on ``(subject, activity, freq)``; pairs with an unseen subject or
    activity are left out of the predictions."""
    return ALS(
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        seed=seed,
        userCol="subject",
        itemCol="activity",
        ratingCol="freq",
        coldStartStrategy="drop",
    ).fit(ratings)


def frequent_itemsets(baskets: DataFrame, items: str, min_support: float) -> DataFrame:
    """``(items, freq)`` with the items of a set sorted and blank-joined. Items must be unique in
    a basket."""
    model = FPGrowth(itemsCol=items, minSupport=min_support).fit(baskets)
    return model.freqItemsets.select(
        F.array_join(F.array_sort("items"), " ").alias("itemset"), F.col("freq").alias("n")
    )


def forest_pipeline(
    cols: Sequence[str], seed: int, trees: int = 20, kind: type[RandomForestRegressor] = RandomForestRegressor
) -> tuple[Pipeline, Normalizer, RandomForestRegressor]:
    """assemble → normalise → random forest; the stages are returned so a fit can override them."""
    assembler = VectorAssembler(inputCols=list(cols), outputCol="features")
    normal = Normalizer(inputCol="features", outputCol="normalized")
    forest = kind(
        featuresCol="normalized", labelCol="label", numTrees=trees, seed=seed
    )
    return Pipeline(stages=[assembler, normal, forest]), normal, forest


def fit_forest(
    train: DataFrame, cols: Sequence[str], seed: int, p: float = 1.0, trees: int = 20, kind: type[RandomForestRegressor] = RandomForestRegressor
) -> PipelineModel | None:
    """Fit with the norm given as a parameter override; an empty batch gives no model."""
    if train.isEmpty():
        return None
    pipeline, normal, _ = forest_pipeline(cols, seed, trees, kind)
    return pipeline.fit(train, params={normal.p: p})


def _grown(train: DataFrame, cols: Sequence[str], seed: int, p: float, sizes: Sequence[int]) -> list[PipelineModel]:
    """Forests that together have each number of trees in ``sizes`` (ascending): each brings what the one before lacks."""
    added = [n - before for before, n in zip([0, *sizes], sizes)]
    return [fit_forest(train, cols, seed + i, p, n) for i, n in enumerate(added)]


def _normalised(rows: DataFrame, cols: Sequence[str], seed: int, p: float) -> DataFrame:
    """What the forest of a pipeline reads, as plain arrays, made once for all folds."""
    assembler, normal, _ = forest_pipeline(cols, seed)[0].getStages()
    ready = normal.transform(assembler.transform(rows), {normal.p: p})
    return ready.select("label", vector_to_array("normalized").alias("normalized"), "_fold")


def _squared_errors(validation: DataFrame, grown: Sequence[PipelineModel], sizes: Sequence[int]) -> tuple[int, list[float]]:
    """Rows, and the sum of squared errors of the forest of every size, in one pass: a forest predicts the mean of its trees."""
    rows, total, errors = validation, F.lit(0.0), []
    for i, (forest, before, n) in enumerate(zip(grown, [0, *sizes], sizes)):
        rows = forest.transform(rows).drop("features", "normalized").withColumnRenamed("prediction", f"_{i}")
        total = total + F.col(f"_{i}") * (n - before)
        errors.append(F.sum(F.pow(total / n - F.col("label"), 2)).alias(f"e{i}"))
    found = rows.agg(F.count("label").alias("n"), *errors).first()
    return found[0], list(found[1:])


def cross_validate(
    train: DataFrame,
    cols: Sequence[str],
    seed: int,
    norms: Sequence[float] = (1.0, 5.0, 10.0),
    trees: Sequence[int] = (10, 50, 100),
    folds: int = 5,
    parallelism: int = 2,
) -> tuple[PipelineModel, DataFrame]:
    """Grid search by RMSE, averaged over the folds; returns the best point's model, fitted to all rows, and ``(p, trees, rmse)`` per grid point.

    The trees of a forest are independent, so a larger forest goes on from the next smaller one: per norm and fold as many trees are
    fitted as the largest forest has, and one pass over the fold left out scores all sizes. Rows are dealt out evenly first.
    Forests of few columns are grown from sums per cell (``forests.CellForest``), in one pass over the rows and not one per level.
    """
    spark, sizes, few = train.sparkSession, sorted(set(trees)), forests.cells_fit(len(cols))
    fold = F.floor(F.rand(seed) * folds).cast("int")
    dealt = train.repartition(2 * spark.sparkContext.defaultParallelism).select("label", *cols, fold.alias("_fold")).cache()
    ready, done = {p: _normalised(dealt, cols, seed, p).cache() if few else dealt for p in norms}, {p: [] for p in norms}
    try:

        def scored(point: tuple[float, int]) -> list[float]:
            p, k = point
            learned, left_out = ready[p].where(F.col("_fold") != k), ready[p].where(F.col("_fold") == k)
            if few:
                forest = forest_pipeline(cols, seed, sizes[-1], forests.CellForest)[-1].fit(learned)
                n, errors = forest.squared_errors(left_out, sizes)
            else:
                n, errors = _squared_errors(left_out, _grown(learned, cols, seed, p, sizes), sizes)
            done[p].append(k)
            if few and len(done[p]) == folds:
                ready[p].unpersist()
            return [(e / n) ** 0.5 for e in errors]

        points = [(p, k) for p in norms for k in range(folds)]
        with ThreadPoolExecutor(parallelism) as pool:
            found = dict(zip(points, pool.map(inheritable_thread_target(spark)(scored), points)))
        scores = [(float(p), int(n), sum(found[p, k][sizes.index(n)] for k in range(folds)) / folds) for p in norms for n in trees]
        best = min(scores, key=lambda score: score[2])
        model = fit_forest(dealt, cols, seed, best[0], best[1], forests.CellForest if few else RandomForestRegressor)
        if few:
            model = PipelineModel([*model.stages[:-1], model.stages[-1].mllib(spark)])
    finally:
        for rows in (*ready.values(), dealt):
            rows.unpersist()
    return model, spark.createDataFrame(scores, "p double, trees int, rmse double")
