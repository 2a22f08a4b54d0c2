"""Frequent-item and quantile sketches, variants, and statements with variables."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import sketches, variables
from millrace.plans.replay import replay
from millrace.sources import variants


def skewed(spark, n, seed):
    draw = random.Random(seed)
    values = [int(draw.paretovariate(0.7)) for _ in range(n)]
    return values, spark.createDataFrame([(v,) for v in values], "v int").repartition(5)


@pytest.mark.parametrize("size", [4, 16, 64])
def test_no_frequent_value_is_missed_and_bounds_hold(spark, size):
    values, df = skewed(spark, 4000, size)
    counts = Counter(values)
    support = 1 / (size + 1)
    summary = sketches.item_summary(df, "v", size)
    assert all(len(r["items"]) <= size and r["lost"] <= r["rows"] / (size + 1) for r in summary.collect())
    found = {r["value"]: (r["at_least"], r["at_most"]) for r in sketches.merged_items(summary, support).collect()}
    assert {v for v, n in counts.items() if n >= support * len(values)} <= set(found)
    assert all(low <= counts[v] <= high for v, (low, high) in found.items())


def test_summaries_of_batches_merge_and_repeat(spark):
    path = scratch.new_dir(spark, "summaries")
    parts = [skewed(spark, 500, seed) for seed in (1, 2, 3)]
    step = sketches.keep_items(path, "v", 30)
    replay(spark, {"rows": [df for _, df in parts]}, lambda rows: rows.writeStream.foreachBatch(step), "items")
    for upto in range(3):
        counts = Counter(v for values, _ in parts[: upto + 1] for v in values)
        found = {r["value"] for r in sketches.kept_items(spark, path, 0.05, upto).collect()}
        assert {v for v, n in counts.items() if n >= 0.05 * sum(counts.values())} <= found
    before = sorted(map(tuple, sketches.kept_items(spark, path, 0.05).collect()))
    step(parts[1][1], 1)  # the batch runs again
    assert sorted(map(tuple, sketches.kept_items(spark, path, 0.05).collect())) == before


def test_items_of_texts_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("é",)], "v string")
    found = sorted(map(tuple, sketches.merged_items(sketches.item_summary(df, "v", 5), 0.5).collect()))
    assert found == [("a", 2, 2)]
    assert sketches.merged_items(sketches.item_summary(df.limit(0), "v", 5), 0.5).collect() == []


def test_rank_errors_of_quantiles(spark):
    draw = random.Random(3)
    values = [draw.choice([draw.gauss(0, 1), 5.0, draw.expovariate(0.1)]) for _ in range(20_000)]
    df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)] + [(None, 1)], "v double, g int")
    merged = sketches.merged_sketches(sketches.quantile_sketches(df, ["v"], ["g"]))
    points = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    row = merged.select(F.kll_sketch_get_n_double("sketch").alias("n"), *[sketches.quantile("sketch", p).alias(f"q{i}") for i, p in enumerate(points)], sketches.rank("sketch", F.lit(5.0)).alias("r")).first()
    assert row["n"] == len(values)
    ordered = sorted(values)
    for i, p in enumerate(points):
        low, high = (sum(v < row[f"q{i}"] for v in ordered), sum(v <= row[f"q{i}"] for v in ordered))
        assert low - 0.02 * len(values) <= p * len(values) <= high + 0.02 * len(values)
    assert row["r"] == pytest.approx(sum(v <= 5.0 for v in values) / len(values), abs=0.02)
    empty = sketches.quantile_sketches(df.limit(0), ["v"]).select(F.kll_sketch_get_n_double("sketch")).first()
    assert empty[0] in (0, None)


def test_variants_keep_every_shape(spark):
    rows = ['{"a": 1, "b": [1, "x", {"c": 2}]}', '{"a": "s", "d": {"k": 1.5, "l": null}}', '{"a": true}', "bad{", "null", "[3]", None]
    docs = variants.parsed(spark.createDataFrame([(r,) for r in rows], "t string"), "t")
    assert variants.schema_of(docs.where("t like '%a%' and t not like 'bad%'")) == "OBJECT<a: VARIANT, b: ARRAY<VARIANT>, d: OBJECT<k: DECIMAL(2,1), l: VOID>>"
    typed = variants.fields(docs, {"number": ("$.a", "int"), "text": ("$.a", "string"), "first": ("$[0]", "int")})
    got = [tuple(r) for r in typed.select("number", "text", "first", variants.type_of("doc", "$.a")).collect()]
    assert got == [(1, "1", None, "BIGINT"), (None, "s", None, "STRING"), (1, "true", None, "BOOLEAN"), (None, None, None, None), (None, None, None, None), (None, None, 3, None), (None, None, None, None)]
    assert [r[0] for r in variants.elements(docs, "$.b").select(F.to_json("element")).collect()] == ["1", '"x"', '{"c":2}']
    pairs = variants.keys_and_values(docs, "$.d", kept=("t",)).select("key", F.to_json("value")).collect()
    assert sorted(map(tuple, pairs)) == [("k", "1.5"), ("l", "null")]


def test_variables_and_markers_carry_values_not_text(spark):
    odd = "it's `odd`; DROP"
    variables.declare(spark, **{"a value": odd, "other": None})
    got = spark.range(1).select(variables.variable("a value"), variables.variable("other")).first()
    assert tuple(got) == (odd, None)
    variables.declare(spark, **{"a value": "second"})
    assert variables.query(spark, "SELECT `a value` AS v, :x AS x FROM {t}", {"x": odd}, t=spark.range(2)).collect()[1] == ("second", odd)
    variables.drop(spark, "a value", "other", "never there")
    with pytest.raises(Exception, match="UNRESOLVED"):
        spark.range(1).select(variables.variable("a value"))
