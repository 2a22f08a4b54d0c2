"""Forests grown from sums per cell against MLlib's own."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from millrace.operators import forests, models

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(1)
    x = draw.random((3000, 3)) * 100
    y = 2 * x[:, 0] + 30 * (x[:, 1] > 40) - x[:, 2] + draw.normal(size=3000) * 10
    return spark.createDataFrame([(float(b), *map(float, a)) for a, b in zip(x, y)], "label double, a double, b double, c double").repartition(3).cache()


def predicted(model, rows):
    return [r[0] for r in model.transform(rows).orderBy(*COLS).select("prediction").collect()]


@pytest.mark.parametrize("extra", [{}, {"maxBins": 16, "maxDepth": 4, "minInstancesPerNode": 40, "minInfoGain": 1.0}])
def test_a_tree_of_all_rows_is_mllibs(spark, rows, extra):
    found = []
    for kind in (RandomForestRegressor, forests.CellForest):
        pipeline, _, forest = models.forest_pipeline(COLS, 7, 1, kind)
        forest.setParams(bootstrap=False, **extra)
        found.append(pipeline.fit(rows))
    own = found[1].stages[-1].mllib(spark)
    assert isinstance(own, RandomForestRegressionModel) and own.totalNumNodes == found[0].stages[-1].totalNumNodes
    assert predicted(found[1], rows) == pytest.approx(predicted(found[0], rows))


def test_bootstraps_do_as_well_as_mllibs_and_errors_are_those_of_the_rows(spark, rows):
    error = {}
    for kind in (RandomForestRegressor, forests.CellForest):
        model = models.fit_forest(rows, COLS, 5, 1.0, 40, kind)
        told = model.transform(rows)
        error[kind] = told.agg(F.sum(F.pow(F.col("prediction") - F.col("label"), 2))).first()[0]
    ready = models.PipelineModel(model.stages[:-1]).transform(rows)
    n, (few, all_) = model.stages[-1].squared_errors(ready, [7, 40])
    assert n == 3000 and all_ == pytest.approx(error[forests.CellForest]) and few != all_
    assert error[forests.CellForest] == pytest.approx(error[RandomForestRegressor], rel=0.1)


def test_bootstrap_counts_are_poisson():
    found = forests.poisson(np.random.Generator(np.random.SFC64(3)), 1_000_000)
    assert np.bincount(found.astype(int), minlength=5)[:5] / 1e6 == pytest.approx(forests._CHANCES[:5], abs=0.003)
    assert found.var() == pytest.approx(1, abs=0.01)


def test_cross_validation_goes_over_the_rows_once_per_fit(spark, rows, monkeypatch):
    """Neither fits of MLlib, which go over the rows once per level, nor norms taken anew for every fold."""
    calls, fit, normalised = [], RandomForestRegressor._fit_java, models._normalised
    monkeypatch.setattr(RandomForestRegressor, "_fit_java", lambda self, df: calls.append("MLlib") or fit(self, df))
    monkeypatch.setattr(models, "_normalised", lambda *a: calls.append("norm") or normalised(*a))
    model, scores = models.cross_validate(rows, COLS, seed=3, norms=(1.0,), trees=(2, 5), folds=2)
    assert calls == ["norm"]
    assert [(r["p"], r["trees"]) for r in scores.collect()] == [(1.0, 2), (1.0, 5)]
    assert isinstance(model.stages[-1], RandomForestRegressionModel) and model.transform(rows).where("prediction IS NOT NULL").count() == 3000


def test_many_columns_are_mllibs(spark, rows):
    wide = rows.withColumn("d", F.col("a") + F.col("b"))
    model, scores = models.cross_validate(wide, [*COLS, "d"], seed=3, norms=(1.0,), trees=(2, 3), folds=2)
    assert model.stages[-1].numFeatures == 4 and all(0 < r["rmse"] < 200 for r in scores.collect())


def test_nulls_are_refused(spark):
    few = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, 3.0)], "label double, a double")
    with pytest.raises(Exception, match="null"):
        models.fit_forest(few, ["a"], 1, kind=forests.CellForest)
