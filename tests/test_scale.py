"""What larger tables showed: forests fitted once, ranks that do not move the rows."""

import pytest
from pyspark.ml.regression import RandomForestRegressor

from millrace.operators import models, skew, stats


def test_a_larger_forest_goes_on_from_a_smaller_one(spark, monkeypatch):
    rows = spark.createDataFrame([(float(i * 7 % 40), float(i % 10), float(i * 37 % 23)) for i in range(400)], "label double, a double, b double")
    fitted, fit = [], RandomForestRegressor._fit

    def counted(self, df):
        fitted.append(self.getNumTrees())
        return fit(self, df)

    monkeypatch.setattr(RandomForestRegressor, "_fit", counted)
    model, scores = models.cross_validate(rows.coalesce(1), ["a", "b"], seed=3, norms=(1.0, 2.0), trees=(5, 2), folds=2)
    found = scores.collect()
    best = min(found, key=lambda r: r["rmse"])
    assert [(r["p"], r["trees"]) for r in found] == [(1.0, 5), (1.0, 2), (2.0, 5), (2.0, 2)]
    assert all(0 < r["rmse"] < 30 for r in found)
    assert sum(fitted) == 2 * 2 * 5 + best["trees"]  # with every size on its own: 2 * 2 * (5 + 2) + best
    assert model.stages[-1].getNumTrees == best["trees"]


@pytest.mark.parametrize("limit", ["10m", "640", "-1"])  # all ranks broadcast; those of few values; none
def test_ranks_of_every_size(spark, limit, monkeypatch):
    rows = [(i % 3, i * 31 % 101, None if i == 5 else i * 17 % 89) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    joined = []
    monkeypatch.setattr(stats, "salted_join", lambda left, right, keys, **o: joined.append(keys) or skew.salted_join(left, right, keys, **o))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        found = {(r["i"], r["j"]): r["r"] for r in stats.correlation_matrix(df, ["a", "b", "c"], "spearman").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert joined == {"10m": [], "640": [["b"]], "-1": [["a"], ["b"]]}[limit]  # one large column never needs a join with the rows

    def ranks(k):
        values = sorted((r[k] is not None, r[k] or 0) for r in rows)
        return [(values.index(v) + 1 + values.index(v) + values.count(v)) / 2 for v in ((r[k] is not None, r[k] or 0) for r in rows)]

    kept = [i for i, r in enumerate(rows) if None not in r]
    columns = {n: [ranks(k)[i] for i in kept] for k, n in enumerate("abc")}

    def r(x, y):
        mx, my = sum(x) / len(x), sum(y) / len(y)
        dot = lambda p, q, mp, mq: sum((u - mp) * (v - mq) for u, v in zip(p, q))
        return dot(x, y, mx, my) / (dot(x, x, mx, mx) * dot(y, y, my, my)) ** 0.5

    for (i, j), value in found.items():
        assert value == pytest.approx(r(columns[i], columns[j]), abs=1e-9)
