"""Statistics and models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import features, models, sampling, stats
from millrace.plans.aggregates import brand_lines
from millrace.plans.base import SLICED_EVENTS, Cases, events, k_of_props, table
from millrace.streaming import models as online
from millrace.plans.replay import SLICES, replay_batches

CASES = Cases()

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem")


def _spread(values: Column, names: list[str], digits: int | None = None) -> list[Column]:
    """Array elements as named columns."""
    cells = [values[i] for i in range(len(names))]
    return [(F.round(c, digits) if digits else c).alias(n) for c, n in zip(cells, names)]


@CASES.query(
    "ml_assemble",
    f"""SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS label, {", ".join(f"{c} AS f{i}" for i, c in enumerate(NUMERIC))}
        FROM lineitem""",
)
def assemble(spark: SparkSession, sf: str) -> DataFrame:
    points = features.labelled(_lines(spark, sf), "l_linenumber", NUMERIC, keep=["l_orderkey"])
    return features.as_array(points).select(
        "l_orderkey", "label", *_spread(F.col("features"), [f"f{i}" for i in range(len(NUMERIC))])
    )


@CASES.query(
    "ml_sparse",
    """SELECT * FROM (SELECT l_orderkey, unnest([0, 1, 2]) AS idx, unnest([l_discount, l_tax, l_quantity]) AS val FROM lineitem)
       WHERE val <> 0""",
)
def sparse(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).select("l_orderkey", F.array("l_discount", "l_tax", "l_quantity").alias("vs"))
    return features.sparse_entries(rows, "l_orderkey", "vs")


@CASES.query(
    "ml_coordinate_matrix",
    """SELECT i, j, round(sum(v), 4) AS v FROM (
         SELECT CAST(0 AS BIGINT) AS i, l_orderkey AS j, l_quantity + l_discount AS v FROM lineitem
         UNION ALL SELECT 1, l_orderkey, l_tax + l_extendedprice FROM lineitem) GROUP BY i, j""",
)
def coordinate_matrix(spark: SparkSession, sf: str) -> DataFrame:
    entries = features.coordinate_entries(
        _lines(spark, sf), "l_orderkey", [["l_quantity", "l_discount"], ["l_tax", "l_extendedprice"]]
    )
    return features.cells(entries).withColumn("v", F.round("v", 4))


_ENTRIES = """e AS (SELECT l_suppkey AS i, l_partkey AS j, CAST(sum(l_quantity) AS DOUBLE) AS v FROM lineitem GROUP BY 1, 2)"""


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    """Quantities by supplier and part."""
    return _lines(spark, sf).select(F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j"), F.col("l_quantity").alias("v"))


@CASES.query(
    "ml_matrix_vector",
    f"WITH {_ENTRIES} SELECT i, round(sum(v * p_retailprice), 2) AS y FROM e JOIN part ON p_partkey = j GROUP BY i",
)
def matrix_vector(spark: SparkSession, sf: str) -> DataFrame:
    prices = table(spark, sf, "part").select(F.col("p_partkey").alias("j"), F.col("p_retailprice").alias("x"))
    return features.times_vector(_entries(spark, sf), prices).withColumn("y", F.round("y", 2))


@CASES.query(
    "ml_block_matrix",
    f"""WITH {_ENTRIES} SELECT i // 64 AS bi, j // 64 AS bj, count(*) AS n, round(sum(v), 2) AS total,
                               min(i % 64 * 64 + j % 64) AS first FROM e GROUP BY 1, 2""",
)
def block_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of 64 by 64, each told by its size, sum and first cell."""
    found = features.blocks(_entries(spark, sf), 64)
    total = F.aggregate("cells", F.lit(0.0), lambda acc, c: acc + c["v"])
    first = F.col("cells")[0]
    return found.select(
        "bi", "bj", F.size("cells").cast("long").alias("n"), F.round(total, 2).alias("total"), (first["i"] * 64 + first["j"]).alias("first")
    )


@CASES.query(
    "ml_indexed_rows",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_index FROM orders",
)
def indexed_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_totalprice", "o_orderkey")
    return features.indexed_rows(rows, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "row_index")


@CASES.query(
    "ml_col_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, max({c}) AS max, min({c}) AS min, round(avg({c}), 6) AS mean,
                   round(sum(abs({c})), 2) AS norm_l1, round(sqrt(sum({c} * {c})), 2) AS norm_l2,
                   count(*) FILTER (WHERE {c} <> 0) AS non_zeros, round(var_samp({c}), 4) AS variance FROM lineitem"""
        for c in NUMERIC
    ),
)
def col_stats(spark: SparkSession, sf: str) -> DataFrame:
    digits = {"mean": 6, "norm_l1": 2, "norm_l2": 2, "variance": 4}
    found = stats.column_stats(_lines(spark, sf), NUMERIC)
    return found.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _matrix_sql(rows: str) -> str:
    cells = (
        f"SELECT '{a}' AS i, '{b}' AS j, round(corr({a}, {b}), 6) AS r FROM t" for a in NUMERIC for b in NUMERIC
    )
    return f"WITH t AS ({rows}) " + " UNION ALL ".join(cells)


@CASES.query("ml_corr_pearson", _matrix_sql("SELECT * FROM lineitem"))
def corr_pearson(spark: SparkSession, sf: str) -> DataFrame:
    cells = stats.correlation_matrix(_lines(spark, sf), NUMERIC, "pearson")
    return cells.withColumn("r", F.round("r", 6))


@CASES.query(
    "ml_corr_spearman",
    _matrix_sql(
        "SELECT "
        + ", ".join(
            f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in NUMERIC
        )
        + " FROM lineitem"
    ),
)
def corr_spearman(spark: SparkSession, sf: str) -> DataFrame:
    cells = stats.correlation_matrix(_lines(spark, sf), NUMERIC, "spearman")
    return cells.withColumn("r", F.round("r", 6))


CATEGORIES = ["line", "tax", "decade"]


def _categorical(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return _lines(spark, sf).select(
        "l_orderkey",
        F.when(flag == "A", 0.0).when(flag == "N", 1.0).otherwise(2.0).alias("label"),
        F.col("l_linenumber").cast("double").alias("line"),
        F.round(F.col("l_tax") * 100).alias("tax"),
        F.floor(F.col("l_quantity") / 10).cast("double").alias("decade"),
    )


_CATEGORICAL = """t AS (SELECT l_returnflag AS label, l_linenumber AS line, round(l_tax * 100) AS tax,
                               floor(l_quantity / 10) AS decade FROM lineitem)"""


def _chi_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, (count(DISTINCT f) - 1) * (count(DISTINCT label) - 1) AS degrees_of_freedom,
                      round(sum(o * o / (rf * rl / total)) - any_value(total), 4) AS statistic
               FROM (SELECT {c} AS f, label, CAST(count(*) AS DOUBLE) AS o,
                            CAST(sum(count(*)) OVER (PARTITION BY {c}) AS DOUBLE) AS rf,
                            CAST(sum(count(*)) OVER (PARTITION BY label) AS DOUBLE) AS rl,
                            CAST(sum(count(*)) OVER () AS DOUBLE) AS total
                     FROM t GROUP BY {c}, label)"""


@CASES.query(
    "ml_chi_square", f"WITH {_CATEGORICAL} " + " UNION ALL ".join(_chi_sql(c) for c in CATEGORIES)
)
def chi_square(spark: SparkSession, sf: str) -> DataFrame:
    tests = stats.chi_square(_categorical(spark, sf), "label", CATEGORIES)
    return tests.select("feature", "degrees_of_freedom", F.round("statistic", 4).alias("statistic"))


_SCALED = ", ".join(f"round({c} / (SELECT stddev_samp({c}) FROM lineitem), 6) AS {c}" for c in NUMERIC)


@CASES.query("ml_standard_scale", f"SELECT l_orderkey, {_SCALED} FROM lineitem")
def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    points = features.labelled(_lines(spark, sf), F.lit(0), NUMERIC, keep=["l_orderkey"])
    scaled = features.standard_scaler(points).transform(points)
    values = features.as_array(scaled, "scaled")
    return values.select("l_orderkey", *_spread(F.col("scaled"), NUMERIC, 6))


def _ordered_chi_sql() -> str:
    """The features by how far their statistic lies in the tail: its cube root over the degrees of freedom is close to normal."""
    tail = "(pow(statistic / degrees_of_freedom, 1 / 3.0) - (1 - 2 / (9.0 * degrees_of_freedom))) / sqrt(2 / (9.0 * degrees_of_freedom))"
    tests = " UNION ALL ".join(_chi_sql(c) for c in CATEGORIES)
    return f"(SELECT list(feature) AS names FROM (SELECT feature FROM ({tests}) ORDER BY {tail} DESC LIMIT 2))"


def _chosen_sql(place: int) -> str:
    """The value of the chosen feature in this place, in the order of the columns."""
    own = [f"WHEN list_contains(names, '{c}') AND {' + '.join(['0'] + [f'list_contains(names, {chr(39)}{b}{chr(39)})::INT' for b in CATEGORIES[:i]])} = {place} THEN {c}" for i, c in enumerate(CATEGORIES)]
    return f"CASE {' '.join(own)} END::DOUBLE"


@CASES.query(
    "ml_select_features",
    f"""WITH t AS (SELECT l_orderkey, l_returnflag AS label, l_linenumber AS line, round(l_tax * 100) AS tax, floor(l_quantity / 10) AS decade FROM lineitem)
        SELECT l_orderkey, CASE label WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END::DOUBLE AS label, {_chosen_sql(0)} AS first, {_chosen_sql(1)} AS second
        FROM t, {_ordered_chi_sql()}""",
)
def select_features(spark: SparkSession, sf: str) -> DataFrame:
    """The two categories that depend most on the label."""
    points = features.labelled(_categorical(spark, sf), "label", CATEGORIES, keep=["l_orderkey"])
    chosen = features.top_features(points, 2).transform(points)
    return features.as_array(chosen, "selected").select(
        "l_orderkey", "label", *_spread(F.col("selected"), ["first", "second"])
    )


@CASES.query(
    "ml_pca",
    """WITH x AS (SELECT vec_id, vec_id % 10 < 3 AS test, unnest(embedding)::DOUBLE AS v, unnest(range(1, len(embedding) + 1)) AS d FROM embeddings),
            spread AS (SELECT sum(var) AS total FROM (SELECT d, var_samp(v) AS var FROM x WHERE NOT test GROUP BY d)),
            sizes AS (SELECT vec_id, sqrt(sum(v * v)) AS whole FROM x GROUP BY vec_id)
       SELECT vec_id, CASE WHEN vec_id % 10 < 3 THEN 'test' ELSE 'train' END AS part, round(whole, 6) AS whole, true AS shorter,
              round(total, 6) AS total, true AS falling, true AS uncorrelated
       FROM sizes, spread""",
)
def pca(spark: SparkSession, sf: str) -> DataFrame:
    """Half the dimensions, fitted on the training part and applied to both.

    ``total`` is the variance of the training part as the model's shares give it back: that of its first component over its share. ``falling``: the
    variances of the components fall; ``uncorrelated``: the first two do not go together; ``shorter``: no projection is longer than its vector.
    """
    rows = sampling.label_split(table(spark, sf, "embeddings"), "vec_id", 3, 10)
    vectors = features.from_array(rows, "embedding")
    model = features.pca(vectors.where("part = 'train'"), 32)
    projected = features.as_array(model.transform(vectors), "components")
    c = F.col("components")
    shares = model.explainedVariance.toArray().tolist()
    facts = projected.where("part = 'train'").agg(
        F.round(F.var_samp(c[0]) / shares[0], 6).alias("total"),
        F.array(*[F.var_samp(c[i]) for i in range(32)]).alias("variances"), F.corr(c[0], c[1]).alias("r"),
    )
    falling = F.forall(F.sequence(F.lit(2), F.lit(32)), lambda i: F.element_at("variances", i) <= F.element_at("variances", i - 1) * (1 + 1e-9))
    facts = facts.select("total", falling.alias("falling"), (F.abs("r") < 1e-6).alias("uncorrelated"))
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    whole = length(F.col("embedding").cast("array<double>"))
    kept = projected.select("vec_id", "part", F.round(whole, 6).alias("whole"), (length(c) <= whole * (1 + 1e-6) + 1e-6).alias("shorter"))
    return kept.crossJoin(F.broadcast(facts))  # one row of facts


_WEIGHTS = ["w1", "w2"]
_MARGIN = "(x.w1 * w.w1 + x.w2 * w.w2)"


def _sensor(spark: SparkSession, sf: str, logistic: bool) -> DataFrame:
    label = (F.col("value") > 50).cast("double") if logistic else F.col("value") / 100
    return events(spark, sf).select(
        "event_id", "ts", label.alias("y"), (k_of_props() / 100).alias("w1"), (F.col("user_id") % 10 / 10).alias("w2")
    )


#: three rows in ten are predicted, not learned
_HELD_OUT = "pmod(event_id, 10) < 3"


def _sgd_sql(label: str, response: str, prediction: str) -> str:
    steps = ["w0 AS (SELECT CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2)"]
    for i in range(SLICES):
        moved = ", ".join(
            f"any_value(w.{c}) - 0.1::DOUBLE * avg(({response} - y) * x.{c}) AS {c}" for c in _WEIGHTS
        )
        steps.append(f"w{i + 1} AS (SELECT {moved} FROM x, w{i} w WHERE batch_id = {i} AND NOT test)")
    rows = f"""x AS (SELECT batch_id, event_id % 10 < 3 AS test, {label} AS y, CAST(k AS DOUBLE) / 100 AS w1,
                            CAST(user_id % 10 AS DOUBLE) / 10 AS w2 FROM sliced)"""
    out = " UNION ALL ".join(
        f"""SELECT CAST({i} AS BIGINT) AS batch, round(any_value(w.w1), 9) AS w1, round(any_value(w.w2), 9) AS w2, count(*) AS n_test,
                   round(avg(({prediction} - y) ** 2), 6) AS mse FROM x, w{i + 1} w WHERE batch_id = {i} AND test"""
        for i in range(SLICES)
    )
    return f"WITH {SLICED_EVENTS}, {rows}, {', '.join(steps)} {out}"


def _online(spark: SparkSession, sf: str, logistic: bool) -> DataFrame:
    path = scratch.new_dir(spark, "weights")
    learn = online.train_sgd(path, "y", _WEIGHTS, step=0.1, logistic=logistic, held_out=_HELD_OUT)
    replay_batches(_sensor(spark, sf, logistic), "ts", learn, "sgd")
    return spark.read.parquet(path).select(
        F.col("batch_id").cast("long").alias("batch"), *[F.round(c, 9).alias(c) for c in _WEIGHTS], "n_test", F.round("mse", 6).alias("mse")
    )


@CASES.query("ml_stream_linreg", _sgd_sql("value / 100", _MARGIN, _MARGIN))
def stream_linreg(spark: SparkSession, sf: str) -> DataFrame:
    return _online(spark, sf, logistic=False)


@CASES.query(
    "ml_stream_logreg",
    _sgd_sql(
        "CAST(value > 50 AS DOUBLE)", f"1 / (1 + exp(-({_MARGIN})))", f"CASE WHEN {_MARGIN} > 0 THEN 1::DOUBLE ELSE 0::DOUBLE END"
    ),
)
def stream_logreg(spark: SparkSession, sf: str) -> DataFrame:
    return _online(spark, sf, logistic=True)


_CENTERS = [[0.1, 0.2, 0.3], [0.5, 0.5, 0.5], [0.2, 0.8, 0.7]]


def _kmeans_sql() -> str:
    first = ", ".join(f"({i}, {a}, {b}, {c})" for i, (a, b, c) in enumerate(_CENTERS))
    steps = [
        f"""c0 AS (SELECT cluster, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(c AS DOUBLE) AS c
                   FROM (VALUES {first}) v(cluster, a, b, c))"""
    ]
    for i in range(SLICES):
        steps.append(
            f"""m{i} AS (SELECT event_id, any_value(x.a) AS a, any_value(x.b) AS b, any_value(x.c) AS c,
                         arg_min(cluster, (x.a - m.a) ** 2 + (x.b - m.b) ** 2 + (x.c - m.c) ** 2) AS cluster
                         FROM x, c{i} m WHERE batch_id = {i} AND NOT test GROUP BY event_id),
                c{i + 1} AS (SELECT o.cluster, coalesce(avg(m.a), any_value(o.a)) AS a, coalesce(avg(m.b), any_value(o.b)) AS b,
                                    coalesce(avg(m.c), any_value(o.c)) AS c
                             FROM c{i} o LEFT JOIN m{i} m ON m.cluster = o.cluster GROUP BY o.cluster),
                t{i} AS (SELECT cluster, count(*) AS n_test FROM (
                             SELECT event_id, arg_min(cluster, (x.a - m.a) ** 2 + (x.b - m.b) ** 2 + (x.c - m.c) ** 2) AS cluster
                             FROM x, c{i + 1} m WHERE batch_id = {i} AND test GROUP BY event_id) GROUP BY cluster)"""
        )
    rows = """x AS (SELECT event_id, batch_id, event_id % 10 < 3 AS test, value / 500 AS a, CAST(k AS DOUBLE) / 100 AS b,
                           CAST(user_id % 10 AS DOUBLE) / 10 AS c FROM sliced)"""
    out = " UNION ALL ".join(
        f"""SELECT CAST({i} AS BIGINT) AS batch, cluster, round(a, 9) AS a, round(b, 9) AS b, round(c, 9) AS c,
                   coalesce(n_test, 0) AS n_test FROM c{i + 1} LEFT JOIN t{i} USING (cluster)"""
        for i in range(SLICES)
    )
    return f"WITH {SLICED_EVENTS}, {rows}, {', '.join(steps)} {out}"


@CASES.query("ml_stream_kmeans", _kmeans_sql())
def stream_kmeans(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "centers")
    point = F.array(F.col("value") / 500, k_of_props() / 100, F.col("user_id") % 10 / 10)
    rows = events(spark, sf).select("event_id", "ts", point.alias("point"))
    replay_batches(rows, "ts", online.train_kmeans(path, "point", _CENTERS, decay=0.0, held_out=_HELD_OUT), "kmeans")
    return spark.read.parquet(path).select(
        F.col("batch_id").cast("long").alias("batch"), "cluster", *_spread(F.col("center"), ["a", "b", "c"], 9), "n_test"
    )


@CASES.query(
    "ml_als",
    """WITH n AS (SELECT event_type, row_number() OVER (ORDER BY event_type NULLS FIRST) AS activity FROM (SELECT DISTINCT event_type FROM events)),
            r AS (SELECT CAST(user_id AS INTEGER) AS subject, CAST(activity AS INTEGER) AS activity, CAST(count(*) AS DOUBLE) AS freq
                  FROM events e JOIN n ON e.event_type IS NOT DISTINCT FROM n.event_type GROUP BY 1, 2),
            s AS (SELECT *, CAST('0x' || substr(md5(subject || ':' || activity), 1, 8) AS BIGINT) % 10 < 3 AS test FROM r)
       SELECT subject, activity, freq, true AS predicted FROM s a WHERE test
          AND EXISTS (FROM s b WHERE b.subject = a.subject AND NOT test) AND EXISTS (FROM s b WHERE b.activity = a.activity AND NOT test)""",
)
def als(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out (user, type) counts predicted from the others."""
    numbers = features.indexed_rows(events(spark, sf).select("event_type").distinct(), ["event_type"])
    numbers = numbers.select(F.col("event_type").alias("kind"), (F.col("row_index") + 1).cast("int").alias("activity"))
    ratings = (
        events(spark, sf)
        .groupBy(F.col("user_id").cast("int").alias("subject"), "event_type")
        .agg(F.count(F.lit(1)).cast("double").alias("freq"))
        .join(numbers, F.col("event_type").eqNullSafe(F.col("kind")))
        .select("subject", "activity", "freq")
    )
    test = F.conv(F.substring(F.md5(F.concat_ws(":", "subject", "activity")), 1, 8), 16, 10).cast("long") % 10 < 3
    predicted = models.recommender(ratings.where(~test), seed=7).transform(ratings.where(test))
    return predicted.select("subject", "activity", "freq", F.col("prediction").isNotNull().alias("predicted"))


_SUPPORT = 0.005


def _itemset_sql(size: int) -> str:
    names = [f"b{i}" for i in range(size)]
    joins = " ".join(
        f"JOIN b {n} ON {n}.l_orderkey = b0.l_orderkey AND {n}.p_brand > {names[i]}.p_brand"
        for i, n in enumerate(names[1:])
    )
    items = " || ' ' || ".join(f"{n}.p_brand" for n in names)
    return f"""SELECT {items} AS itemset, count(*) AS n FROM b b0 {joins} GROUP BY 1
               HAVING count(*) >= {_SUPPORT} * (SELECT count(DISTINCT l_orderkey) FROM b)"""


@CASES.query(
    "ml_fp_growth",
    "WITH b AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey) "
    + " UNION ALL ".join(_itemset_sql(n) for n in (1, 2, 3)),
)
def fp_growth(spark: SparkSession, sf: str) -> DataFrame:
    baskets = (
        brand_lines(spark, sf)
        .distinct()
        .groupBy("l_orderkey")
        .agg(F.collect_set("p_brand").alias("items"))  # at most one entry per brand
    )
    return models.frequent_itemsets(baskets, "items", _SUPPORT)


_L1 = " + ".join(f"abs({c})" for c in NUMERIC)


@CASES.query(
    "ml_normalize_l1",
    f"SELECT l_orderkey, {', '.join(f'round({c} / ({_L1}), 9) AS {c}' for c in NUMERIC)} FROM lineitem",
)
def normalize_l1(spark: SparkSession, sf: str) -> DataFrame:
    points = features.labelled(_lines(spark, sf), F.lit(0), NUMERIC, keep=["l_orderkey"])
    normal = features.as_array(features.normalizer(1.0).transform(points), "normalized")
    return normal.select("l_orderkey", *_spread(F.col("normalized"), NUMERIC, 9))


def _activity(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        "event_id",
        F.col("value").alias("label"),
        k_of_props().cast("double").alias("hand"),
        F.col("user_id").cast("double").alias("chest"),
        F.hour("ts").cast("double").alias("ankle"),
    )


_BODY = ["hand", "chest", "ankle"]


@CASES.query(
    "ml_forest_pipeline",
    """SELECT event_id, value AS label, true AS within FROM events WHERE event_id % 10 < 3""",
)
def forest_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions for the held-out rows; a forest averages labels, so they lie between those it has seen."""
    rows = sampling.label_split(_activity(spark, sf), "event_id", 3, 10)
    train = rows.where("part = 'train'")
    model = models.fit_forest(train, _BODY, seed=7)
    low, high = train.agg(F.min("label"), F.max("label")).first()
    found = model.transform(rows.where("part = 'test'"))
    return found.select("event_id", "label", F.col("prediction").between(low - 1e-9, high + 1e-9).alias("within"))


@CASES.query(
    "ml_cross_validate",
    """SELECT p::DOUBLE AS p, trees, true AS scored, count(*) FILTER (WHERE event_id % 10 < 3) AS predicted
       FROM events, (SELECT unnest([1, 5, 10]) AS p), (SELECT unnest([10, 50, 100]) AS trees) GROUP BY ALL""",
)
def cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    """The whole grid by five folds on seven rows in ten, and how many of the others the best model predicts.

    The grid is scored against the mean: a point counts if its error is finite and not above 1.5 times that of the mean.
    """
    rows = sampling.label_split(_activity(spark, sf), "event_id", 3, 10)
    train = rows.where("part = 'train'").cache()
    try:
        best, scores = models.cross_validate(train, _BODY, seed=7, parallelism=4)
        predicted = best.transform(rows.where("part = 'test'")).where("prediction IS NOT NULL").count()
        mean_error = train.agg(F.stddev_pop("label")).first()[0]
    finally:
        train.unpersist()
    return scores.select("p", "trees", (F.col("rmse") <= 1.5 * mean_error).alias("scored"), F.lit(predicted).alias("predicted"))


@CASES.query(
    "ml_mse", "SELECT round(avg((value - CAST(props->>'$.k' AS INTEGER)) ** 2), 4) AS mse FROM events"
)
def mse(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("value", k_of_props().alias("k"))
    return stats.mean_squared_error(rows, "value", "k").withColumn("mse", F.round("mse", 4))
