"""Joins, aggregates, sets, samples, statistics, models and the graph on small inputs."""

import math
import os
import random
import subprocess
import sys
import tempfile

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import (
    aggregate,
    features,
    graph,
    joins,
    layout,
    models,
    order,
    sampling,
    sets,
    stats,
    udf,
)
from millrace.operators.skew import hot_keys, salted_join
from millrace.streaming import models as online


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some keys null, some without a partner."""
    rows = [(i, 0 if i % 3 == 0 else (None if i % 50 == 1 else i % 40)) for i in range(1200)]
    return spark.createDataFrame(rows, "id int, k int").cache()


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame([(k, f"name{k}") for k in range(30)], "k int, name string").cache()


def test_hot_keys_hold_every_frequent_key_and_stay_few(skewed):
    found = {r["k"] for r in hot_keys(skewed, ["k"], 0.1).collect()}
    assert 0 in found and len(found) <= 10


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, dimension, no_broadcast, how):
    salted = salted_join(skewed, dimension, ["k"], how, spread_by=["id"], support=0.05, salts=7)
    plain = skewed.join(dimension, ["k"], how)
    assert sorted(salted.select(*plain.columns).collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_salted_join_spreads_the_hot_key(spark, skewed, dimension, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(skewed, dimension, ["k"], spread_by=["id"], support=0.1, salts=16)
        parts = joined.where("k = 0").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1


def test_small_right_side_is_broadcast_unsalted(skewed, dimension, capsys):
    small = dimension.where("k < 3")
    salted_join(skewed, small, ["k"], spread_by=["id"]).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "_salt" not in plan


def test_set_forms_treat_nulls_as_equal_and_use_one_exchange(spark, capsys):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "i int, s string")
    b = spark.createDataFrame([(1, None), (3, "y"), (4, "z")], "i int, s string")
    assert sets.intersect(a, b).exceptAll(a.intersect(b)).isEmpty() and sets.intersect(a, b).count() == 2
    assert sets.subtract(a, b).collect() == [(2, "x")]
    sets.subtract(a, b).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_salting_refuses_full_joins(skewed, dimension):
    with pytest.raises(ValueError):
        salted_join(skewed, dimension, ["k"], "full", spread_by=["id"])


def test_exclusive_keeps_duplicates_unlike_the_set_forms(spark, no_broadcast):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "c")], "id int, k string")
    right = spark.createDataFrame([("b",), ("b",)], "k string")
    only = joins.exclusive(left, right, ["k"], ["id"])
    assert sorted(r["k"] for r in only.collect()) == ["a", "a", "c", "c"]
    assert sorted(r["k"] for r in sets.subtract(left.select("k"), right).collect()) == ["a", "c"]
    both = sets.differences(left.select("k"), spark.createDataFrame([("b",), ("d",), (None,)], "k string"))
    assert set(both.collect()) == {("a", "first"), ("c", "first"), ("d", "second"), (None, "second")}
    sided = left.withColumn("side", F.col("id") % 2).unionByName(spark.createDataFrame([(9, None, 1), (10, None, 0)], "id int, k string, side int"))
    assert sorted(r["id"] for r in joins.exclusive_sides(sided, "side", ["k"], ["id"]).collect()) == [3, 9, 10]


def test_cogroup_chunks_cover_both_sides(spark, no_broadcast):
    left = spark.createDataFrame([(i, "hot", f"l{i}") for i in range(100)] + [(200, "left", "x")], "id long, k string, v string")
    right = spark.createDataFrame([(i, "hot", f"r{i}") for i in range(60)] + [(300, "right", "y")], "id long, k string, v string")
    rows = joins.cogroup(left, right, "k", "v", "id", chunk_rows=20).collect()
    assert max(len(r["left_values"]) + len(r["right_values"]) for r in rows) <= 40
    gathered = {}
    for r in rows:
        both = gathered.setdefault(r["k"], ([], []))
        both[0].extend(r["left_values"])
        both[1].extend(r["right_values"])
    assert sorted(gathered["hot"][0]) == sorted(f"l{i}" for i in range(100))
    assert sorted(gathered["hot"][1]) == sorted(f"r{i}" for i in range(60))
    assert gathered["left"] == (["x"], []) and gathered["right"] == ([], ["y"])
    stepped = spark.range(0, 3200, 8).select("id", F.lit("k").alias("k"), F.col("id").cast("string").alias("v"))
    sizes = [len(r["left_values"]) for r in joins.cogroup(stepped, stepped.limit(0), "k", "v", "id", chunk_rows=50).collect()]
    assert sum(sizes) == 400 and len(sizes) == 8 and max(sizes) < 100


def test_left_outer_default_and_lookup_chain(spark, dimension):
    left = spark.createDataFrame([(1,), (99,)], "k int")
    right = spark.createDataFrame([(1, 2.5)], "k int, rank double")
    assert sorted(joins.left_outer_default(left, right, ["k"], {"rank": 0.0}).collect()) == [(1, 2.5), (99, 0.0)]


def test_lookup_function_and_join_agree(spark):
    facts = spark.createDataFrame([(1, 49), (2, 33), (3, 7), (4, 1)], "id int, code int")
    first = spark.createDataFrame([(49, "DE"), (33, "FR"), (1, "XX")], "code int, via string")
    second = spark.createDataFrame([("DE", "Germany"), ("FR", "France")], "via string, name string")
    joined = joins.lookup_chain(facts, first, second, "code", "via", "name", ["id"]).select("id", "name")
    udf.register_lookup(spark, "cn", first, second)
    called = spark.sql("SELECT id, cn(code) AS name FROM {f}", f=facts)
    want = [(1, "Germany"), (2, "France"), (3, "NotFound"), (4, "NotFound")]
    assert sorted(joined.collect()) == want == sorted(called.collect())


def test_lookup_default_with_an_apostrophe(spark):
    names = spark.createDataFrame([(1, 1)], "code int, via int"), spark.createDataFrame([(1, "one")], "via int, name string")
    udf.register_lookup(spark, "named", *names, default="it's \\ none")
    assert [r[0] for r in spark.sql("SELECT named(x) FROM VALUES (1), (2) AS t(x)").collect()] == ["one", "it's \\ none"]


def test_grouping_then_summing_equals_combining(skewed):
    combined = aggregate.reduce_by_key(skewed, ["k"], F.col("id"), "s").collect()
    grouped = (
        skewed.groupBy("k").agg(F.collect_list("id").alias("ids"))
        .select("k", F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("s")).collect()
    )
    assert sorted(combined, key=repr) == sorted(grouped, key=repr)


def test_partial_aggregation_comes_before_the_exchange(skewed, capsys):
    aggregate.reduce_by_key(skewed, ["k"], F.col("id"), "s").explain("formatted")
    assert "partial_sum" in capsys.readouterr().out


def test_average_is_true_division(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    assert aggregate.average_by_key(df, ["k"], F.col("v"), "m").collect() == [("a", 1.5)]


def test_first_by_and_first_per_partition(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, t int, v string")
    assert sorted(aggregate.first_by(df, ["k"], ["t"]).collect()) == [("a", 1, "y"), ("b", 2, "z")]
    odd = spark.createDataFrame([("a", None, "n"), ("a", 5, "y"), ("a", 5, "x"), (None, None, "z")], "k string, t int, v string")
    assert set(aggregate.first_by(odd, ["k"], ["t"]).collect()) == {("a", 5, "x"), (None, None, "z")}
    spread = df.repartition(8, "k")  # most partitions are empty
    assert len(aggregate.first_per_partition(spread, ["t"]).collect()) <= 2


def test_basket_has_no_duplicates(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b")], "k int, i string")
    assert aggregate.basket(df, "k", "i").collect() == [(1, "a b")]


def test_frequent_items_sketch_holds_the_exact_ones(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    exact = {r[0] for r in aggregate.frequent_items(lines, "l_linenumber", 0.1).collect()}
    sketch = set(lines.stat.freqItems(["l_linenumber"], 0.1).first()[0])
    assert exact and exact <= sketch


def test_crosstab_is_long_for_any_number_of_values(spark):
    df = spark.createDataFrame([("a", i) for i in range(1001)] + [("b", 0), ("b", None)], "r string, c int")
    cells = aggregate.crosstab(df, "r", "c")
    assert cells.columns == ["r", "c", "n"] and cells.count() == 1003
    wide = aggregate.crosstab_wide(df, "r", "c", [0, 1])
    assert wide.columns == ["r", "0", "1"] and {tuple(r) for r in wide.collect()} == {("a", 1, 1), ("b", 1, 0)}


def test_rollup_and_cube_null_placement(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "a int, b int")
    rolled = aggregate.rollup_counts(df, "a", "b").orderBy(F.desc("a"), F.desc("b")).collect()
    assert rolled[-1] == (None, None, 3)
    assert aggregate.cube_counts(df, "a", "b").count() == 3 + 2 + 2 + 1


def test_ordering_is_kept_and_ties_are_settled(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "k string, n long")
    assert order.by_value_desc(df, "n", ["k"]).collect() == [(5, "c"), (2, "a"), (2, "b")]
    assert order.top_n(df, 2, ["n"], ["k"]).collect() == [("c", 5), ("a", 2)]


def test_actions(spark):
    df = spark.range(5).orderBy("id")
    assert df.first()[0] == 0 and df.head()[0] == 0 and [r[0] for r in df.head(2)] == [0, 1]
    assert [r[0] for r in df.take(2)] == [0, 1] and df.count() == 5 and len(df.collect()) == 5


def test_layout(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 5)
    assert layout.spread(df, 4).rdd.getNumPartitions() == 4
    assert layout.spread(df, 6, ["k"]).rdd.getNumPartitions() == 6
    assert layout.shrink(layout.spread(df, 4), 1).rdd.getNumPartitions() == 1
    seen = []
    layout.shared(df, [lambda d: seen.append(d.count()), lambda d: seen.append(d.storageLevel.useMemory)])
    assert seen == [100, True] and not df.is_cached


def test_samples_and_splits(spark):
    df = spark.range(5000)
    kept = sampling.hashed(df, ["id"], 0.7)
    assert 3300 < kept.count() < 3700
    assert kept.exceptAll(sampling.hashed(df.repartition(3), ["id"], 0.7)).isEmpty()
    assert 3300 < sampling.bernoulli(df, 0.7, 1).count() < 3700
    assert sampling.with_replacement(df, 0.5, 1).count() > 2200
    test, train = sampling.random_split(df, 0.3, 1)
    assert test.count() + train.count() == 5000 and test.intersect(train).isEmpty()


def test_pipe_and_user_aggregate(spark):
    df = spark.createDataFrame([("abc",), ("x y",)], "v string")
    assert sorted(r[0] for r in udf.pipe_lines(df, "v", "tr a-z A-Z").collect()) == ["ABC", "X Y"]


def test_average_ranks_share_ties(spark):
    df = spark.createDataFrame([(v,) for v in [5, 1, 5, 2, 5, 2]], "v int").repartition(3)
    ranks = {r["v"]: r["rank"] for r in stats.average_ranks(df, "v").collect()}
    assert ranks == {1: 1.0, 2: 2.5, 5: 5.0}


def test_correlation_of_many_distinct_values(spark):
    rng = random.Random(3)
    rows = [(x := rng.random(), x**3 + rng.random() / 10) for _ in range(300)]
    df = spark.createDataFrame(rows, "a double, b double")
    small = {(r["i"], r["j"]): r["r"] for r in stats.correlation_matrix(df, ["a", "b"], "spearman").collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = {(r["i"], r["j"]): r["r"] for r in stats.correlation_matrix(df, ["a", "b"], "spearman").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    a, b = (np.argsort(np.argsort([r[i] for r in rows])) for i in (0, 1))
    assert math.isclose(small["a", "b"], np.corrcoef(a, b)[0, 1], abs_tol=1e-9)
    assert math.isclose(small["a", "b"], large["a", "b"], abs_tol=1e-9)


def test_constant_column_statistics(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 3.0)], "a double, b double")
    rows = {r["column"]: r for r in stats.column_stats(df, ["a", "b"]).collect()}
    assert rows["a"]["variance"] == 0.0 and rows["b"]["non_zeros"] == 1
    points = features.labelled(df, F.lit(0), ["a", "b"])
    scaled = features.standard_scaler(points).transform(points).select(vector_to_array("scaled")).collect()
    assert all(r[0][0] == 0.0 for r in scaled)  # a constant has no scale


def test_matrix_cells_sum_duplicates_and_multiply(spark, no_broadcast):
    entries = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (0, 1, 4.0), (1, 1, 5.0)], "i long, j long, v double")
    assert sorted(features.cells(entries).collect()) == [(0, 0, 3.0), (0, 1, 4.0), (1, 1, 5.0)]
    vector = spark.createDataFrame([(0, 10.0), (1, 1.0)], "j long, x double")
    assert sorted(features.times_vector(entries, vector).collect()) == [(0, 34.0), (1, 5.0)]
    assert sorted(features.row_matrix(entries, [0, 1]).collect()) == [(0, 3.0, 4.0), (1, 0.0, 5.0)]


def test_indexed_rows_follow_the_order(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("v")).repartition(5)
    rows = features.indexed_rows(df, ["v"]).collect()
    assert sorted((r["v"], r["row_index"]) for r in rows) == [(i, i) for i in range(1000)]


def test_selected_features_have_the_lowest_p_values(spark):
    rng = random.Random(5)
    rows = [(float(i % 3), float(i % 3), float(rng.randrange(4)), float((i % 3) ** 2 % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "label double, a double, b double, c double")
    tests = {r["feature"]: r["p_value"] for r in stats.chi_square(df, "label", ["a", "b", "c"]).collect()}
    points = features.labelled(df, "label", ["a", "b", "c"])
    chosen = features.top_features(points, 2).selectedFeatures
    assert sorted(chosen) == sorted(sorted(range(3), key=lambda i: tests["abc"[i]])[:2])


def test_pca_keeps_the_variance_of_numpy(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(80, 6)) @ rng.normal(size=(6, 6))
    df = features.from_array(spark.createDataFrame([(row.tolist(),) for row in data], "v array<double>"), "v")
    model = features.pca(df, 3)
    values = np.linalg.eigvalsh(np.cov(data.T))[::-1]
    assert np.allclose(model.explainedVariance.toArray(), (values / values.sum())[:3])


def test_recommender_beats_the_mean(spark):
    rng = np.random.default_rng(2)
    u, v = rng.random((40, 2)) + 0.5, rng.random((12, 2)) + 0.5
    cells = [(i, j, float(u[i] @ v[j])) for i in range(40) for j in range(12)]
    ratings = spark.createDataFrame(cells, "subject int, activity int, freq double")
    train = sampling.hashed(ratings, ["subject", "activity"], 0.8)
    test = ratings.exceptAll(train)
    done = models.recommender(train, seed=1, rank=2).transform(test)
    mse = stats.mean_squared_error(done, "freq", "prediction").first()[0]
    assert mse < np.var([c[2] for c in cells]) / 4


def test_empty_batch_gives_no_forest(spark):
    empty = spark.createDataFrame([], "label double, a double")
    assert models.fit_forest(empty, ["a"], seed=1) is None


def test_sgd_step_and_empty_batch(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0)], "x double, y double")
    (row,) = online.sgd_step(df, "y", ["x"], [0.0], 0.1, logistic=False).collect()
    assert math.isclose(row["x"], 0.65)
    (same,) = online.sgd_step(df.limit(0), "y", ["x"], [0.5], 0.1, logistic=False).collect()
    assert same["x"] == 0.5


def test_kmeans_decay(spark):
    df = spark.createDataFrame([([0.0],), ([2.0],), ([10.0],)], "p array<double>")
    centers, weights = [[1.5], [9.0], [100.0]], [2.0, 0.0, 1.0]
    forgetful = online.kmeans_step(df, "p", centers, weights, decay=0.0)
    assert forgetful == [([1.0], 2.0), ([10.0], 1.0), ([100.0], 0.0)]
    steady = online.kmeans_step(df, "p", centers, weights, decay=1.0)
    assert steady == [([1.25], 4.0), ([10.0], 1.0), ([100.0], 1.0)]


def test_graph_drops_unknown_friends_and_counts_repeats(spark, no_broadcast):  # ghost has no user record
    adjacency = spark.createDataFrame(
        [("a", ["b", "b", "ghost"]), ("b", ["a", "c"]), ("c", []), ("d", ["a"])], "user string, friends array<string>"
    )
    users = adjacency.select(F.col("user").alias("id"))
    inside = graph.subgraph(graph.edges(adjacency, "user", "friends"), users)
    assert sorted(inside.collect()) == [("a", "b"), ("a", "b"), ("b", "a"), ("b", "c"), ("d", "a")]
    ranks = {r["id"]: r["rank"] for r in graph.pagerank(inside, users, tolerance=1e-9).collect()}
    a = 0.15 + 0.85 * (ranks["b"] / 2 + ranks["d"])
    assert math.isclose(ranks["a"], a, abs_tol=1e-6) and math.isclose(ranks["d"], 0.15)
    assert math.isclose(ranks["b"], 0.15 + 0.85 * ranks["a"], abs_tol=1e-6)
    named = users.unionByName(spark.createDataFrame([("z",)], "id string"))
    top = graph.top_ranked(named, spark.createDataFrame(list(ranks.items()), "id string, rank double"), 10)
    assert top.collect()[-1] == ("z", 0.0)


def test_ranks_are_never_returned_before_they_settle(spark):
    chain = spark.createDataFrame([(0, 1), (1, 0), (1, 2), (2, 0)], "src int, dst int")
    users = spark.range(3).select(F.col("id").cast("int"))
    with pytest.raises(RuntimeError):
        graph.pagerank(chain, users, tolerance=1e-9, max_rounds=2)
    with pytest.raises(ValueError):
        graph.pagerank(chain, users, tolerance=None)


def test_ranks_of_a_closed_graph_sum_to_its_size(spark):
    ring = spark.createDataFrame([(i, (i + 1) % 7) for i in range(7)] + [(0, 3)], "src int, dst int")
    users = spark.range(7).select(F.col("id").cast("int"))
    total = graph.pagerank(ring, users, tolerance=1e-8).agg(F.sum("rank")).first()[0]
    assert math.isclose(total, 7.0, abs_tol=1e-4)


def test_scratch_without_a_configured_folder():
    code = """
from pyspark.sql import SparkSession
from millrace import scratch
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert scratch.cut(spark.range(3)).count() == 3
assert scratch.new_dir(spark, "a").rsplit("/", 1)[0] == scratch.new_dir(spark, "b").rsplit("/", 1)[0]
"""
    plain = {k: v for k, v in os.environ.items() if k not in ("SPARK_CONF_DIR", "PYSPARK_SUBMIT_ARGS", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    with tempfile.TemporaryDirectory() as empty:
        run = subprocess.run([sys.executable, "-c", code], env=plain | {"SPARK_CONF_DIR": empty}, cwd=os.path.dirname(os.path.dirname(__file__)), capture_output=True, text=True)
    assert run.returncode == 0, run.stderr[-2000:]


def test_scratch_lives_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch.new_dir(spark, "x").startswith(shared) and scratch.new_dir(spark, "x") != scratch.new_dir(spark, "x")
    cut = scratch.cut(spark.range(3))
    assert cut.count() == 3 and "LogicalRDD" in cut._jdf.queryExecution().logical().toString()
