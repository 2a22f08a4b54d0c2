"""Aggregation, ordering and tabular statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas, scratch
from millrace.functions import clean
from millrace.functions import text as X
from millrace.functions.times import wall
from millrace.operators import aggregate, joins, order, sets, sketches, stats
from millrace.plans.base import SLICED_EVENTS, Cases, cdr_text, events, table
from millrace.plans.projections import TOKENS
from millrace.plans.replay import day_slices, replay

CASES = Cases()


def rows() -> Column:
    return F.count(F.lit(1)).alias("n")


@CASES.query("agg_count_per_bucket", "SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1")
def count_per_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).groupBy(wall(F.date_trunc("hour", "ts")).alias("hour")).agg(rows())


@CASES.query(
    "agg_count_by_value", "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL"
)
def count_by_value(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.count_by_value(events(spark, sf).select("event_type", "user_id"))


@CASES.query(
    "agg_total_words", f"SELECT CAST(sum(len({TOKENS})) AS BIGINT) AS total_words FROM documents"
)
def total_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").agg(
        F.sum(X.token_count("text").cast("long")).alias("total_words")
    )


@CASES.query(
    "agg_reduce_by_key",
    "SELECT l_suppkey, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY l_suppkey",
)
def reduce_by_key(spark: SparkSession, sf: str) -> DataFrame:
    sums = aggregate.reduce_by_key(table(spark, sf, "lineitem"), ["l_suppkey"], F.col("l_quantity"), "total")
    return sums.withColumn("total", F.round("total", 2))


@CASES.query(
    "agg_reduce_by_pair",
    """SELECT l_suppkey AS start_station, l_partkey % 50 AS end_station, count(*) AS trips FROM lineitem GROUP BY ALL""",
)
def reduce_by_pair(spark: SparkSession, sf: str) -> DataFrame:
    trips = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("start_station"), (F.col("l_partkey") % 50).alias("end_station")
    )
    return aggregate.reduce_by_key(trips, ["start_station", "end_station"], F.lit(1), "trips")


@CASES.query(
    "agg_avg_combiner",
    f"SELECT source, round(avg(len({TOKENS})), 6) AS avg_words FROM documents GROUP BY source",
)
def avg_combiner(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    words = aggregate.average_by_key(docs, ["source"], X.token_count("text"), "avg_words")
    return words.withColumn("avg_words", F.round("avg_words", 6))


@CASES.query(
    "agg_min_by",
    """SELECT event_type, min(ts) AS ts, arg_min(event_id, ts) AS event_id, arg_min(user_id, ts) AS user_id
       FROM events GROUP BY event_type""",
)
def min_by(spark: SparkSession, sf: str) -> DataFrame:
    found = events(spark, sf).select("event_type", "ts", "event_id", "user_id")
    return aggregate.first_by(found, ["event_type"], ["ts"])


@CASES.query("agg_group_count", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def group_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(rows())


def _single(fn: str, key: str, col: str):
    sql = f"SELECT {key}, round({fn}({col}), 4) AS x FROM lineitem GROUP BY {key}"

    def run(spark: SparkSession, sf: str) -> DataFrame:
        grouped = table(spark, sf, "lineitem").groupBy(key)
        return grouped.agg(F.round(getattr(F, fn)(col), 4).alias("x"))

    CASES.query(f"agg_{fn}", sql)(run)


_single("avg", "l_linenumber", "l_extendedprice")
_single("max", "l_linenumber", "l_extendedprice")
_single("min", "l_linenumber", "l_extendedprice")
_single("sum", "l_suppkey", "l_extendedprice")

_FIVE = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
_FIVE_SQL = ", ".join(f"round(sum({c}), 2) AS sum_{c}" for c in _FIVE)


def _sums():
    return [F.round(F.sum(c), 2).alias(f"sum_{c}") for c in _FIVE]


@CASES.query(
    "agg_multi",
    f"SELECT l_suppkey, {_FIVE_SQL}, round(sum(l_extendedprice / 1000), 2) AS calls_out FROM lineitem GROUP BY l_suppkey",
)
def multi(spark: SparkSession, sf: str) -> DataFrame:
    calls = F.round(F.sum(F.col("l_extendedprice") / 1000), 2).alias("calls_out")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(*_sums(), calls)


@CASES.query("agg_global", f"SELECT {_FIVE_SQL} FROM lineitem")
def global_sums(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(*_sums())


@CASES.query(
    "agg_rollup",
    "SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_suppkey, l_linenumber)",
)
def rollup(spark: SparkSession, sf: str) -> DataFrame:
    counts = aggregate.rollup_counts(table(spark, sf, "lineitem"), "l_suppkey", "l_linenumber")
    return counts.orderBy(F.desc("l_suppkey"), F.desc("l_linenumber"))


@CASES.query(
    "agg_cube",
    "SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY CUBE (l_suppkey, l_linenumber)",
)
def cube(spark: SparkSession, sf: str) -> DataFrame:
    counts = aggregate.cube_counts(table(spark, sf, "lineitem"), "l_suppkey", "l_linenumber")
    return counts.orderBy(F.desc("l_suppkey"), F.desc("l_linenumber"))


@CASES.query(
    "agg_sql_topk",
    """SELECT o_custkey, count(o_orderpriority) AS cnt FROM orders GROUP BY o_custkey ORDER BY cnt DESC, o_custkey LIMIT 5""",
)
def sql_topk(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """SELECT o_custkey, COUNT(o_orderpriority) AS cnt FROM {orders}
           GROUP BY o_custkey ORDER BY cnt DESC, o_custkey LIMIT 5""",
        orders=table(spark, sf, "orders"),
    )


@CASES.query(
    "agg_sql_bucket_sum",
    """SELECT strftime(ts, '%y-%m-%d|%H') AS bucket, round(sum(value + user_id), 4) AS activity FROM events GROUP BY 1""",
)
def sql_bucket_sum(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """SELECT date_format(ts, :fmt) AS bucket, round(sum(value + user_id), 4) AS activity FROM {events}
           GROUP BY 1 ORDER BY activity DESC, bucket""",
        args={"fmt": "yy-MM-dd|HH"},
        events=events(spark, sf),
    )


@CASES.query(
    "agg_dedup_subset",
    """SELECT l_tax, l_discount, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_tax, l_discount
                                  ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def dedup_subset(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (tax, discount); which one is settled by a total order."""
    order_by = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf, "lineitem").select("l_tax", "l_discount", *order_by)
    return aggregate.first_by(lines, ["l_tax", "l_discount"], order_by)


@CASES.query("agg_distinct", "SELECT DISTINCT l_suppkey, l_linenumber, l_tax FROM lineitem")
def distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_tax").distinct()


@CASES.query("agg_distinct_set", "SELECT count(DISTINCT o_custkey) AS size FROM orders")
def distinct_set(spark: SparkSession, sf: str) -> DataFrame:
    """Size of the set of customers; unlike an accumulator it does not count a retried task twice."""
    return table(spark, sf, "orders").agg(F.count_distinct("o_custkey").alias("size"))


@CASES.query(
    "agg_basket",
    """SELECT l_orderkey, string_agg(DISTINCT p_brand, ' ' ORDER BY p_brand) AS basket
       FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""",
)
def basket(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.basket(brand_lines(spark, sf), "l_orderkey", "p_brand")


def brand_lines(spark: SparkSession, sf: str) -> DataFrame:
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return joins.inner(lines, brands, ["l_partkey"], spread_by=["l_orderkey"]).select("l_orderkey", "p_brand")


@CASES.query(
    "stat_corr", "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 9) AS corr FROM lineitem GROUP BY 1"
)
def corr(spark: SparkSession, sf: str) -> DataFrame:
    pairs = stats.pair_stats(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return pairs.select("l_returnflag", F.round("corr", 9).alias("corr"))


@CASES.query("stat_cov", "SELECT round(covar_samp(l_quantity, l_tax), 9) AS cov FROM lineitem")
def cov(spark: SparkSession, sf: str) -> DataFrame:
    pairs = stats.pair_stats(table(spark, sf, "lineitem"), [], "l_quantity", "l_tax")
    return pairs.select(F.round("cov", 9).alias("cov"))


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@CASES.query(
    "stat_crosstab_long",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL",
)
def crosstab_long(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@CASES.query(
    "stat_crosstab",
    """SELECT o_orderstatus, """
    + ", ".join(f"""count(*) FILTER (WHERE o_orderpriority = '{p}') AS "{p}" """ for p in PRIORITIES)
    + " FROM orders GROUP BY o_orderstatus",
)
def crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.crosstab_wide(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES)


@CASES.query(
    "stat_freq_items",
    """SELECT l_linenumber, count(*) AS n FROM lineitem GROUP BY l_linenumber
       HAVING count(*) >= 0.1 * (SELECT count(*) FROM lineitem)""",
)
def freq_items(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.frequent_items(table(spark, sf, "lineitem"), "l_linenumber", 0.1)


_ITEM = "event_type || ':' || CAST(floor(value / 20) AS INTEGER)"
_ITEM_SHARE = 0.02


@CASES.query(
    "stat_freq_batches",
    f"""WITH {SLICED_EVENTS}, upto AS (SELECT b.batch, {_ITEM} AS item FROM sliced s JOIN (SELECT unnest([0, 1, 2])::BIGINT AS batch) b ON s.batch_id <= b.batch)
        SELECT batch, item, count(*) AS n FROM upto u GROUP BY batch, item
        HAVING count(*) >= {_ITEM_SHARE} * (SELECT count(*) FROM upto v WHERE v.batch = u.batch)""",
)
def freq_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The frequent items of a stream after each batch: candidates from the kept summaries, counted exactly.

    The summaries have 60 counters a task, whatever the number of values; a candidate that falls short is dropped by the count.
    """
    path = scratch.new_dir(spark, "summaries")
    rows = events(spark, sf).select(F.expr(_ITEM).alias("item"), "ts")
    slices = day_slices(rows, "ts")
    replay(spark, {"rows": slices}, lambda rows: rows.writeStream.foreachBatch(sketches.keep_items(path, "item", 60)), "freq-batches")
    out = []
    for batch in range(len(slices)):
        candidates = sketches.kept_items(spark, path, _ITEM_SHARE, upto=batch).select(F.col("value").alias("item"))
        so_far = sets.union_all(*slices[: batch + 1])
        total = spark.read.parquet(path).where(F.col("batch_id") <= batch).agg(F.sum("rows").alias("all_rows"))
        counted = so_far.join(candidates, "item", "left_semi").groupBy("item").agg(F.count(F.lit(1)).alias("n"))
        frequent = counted.crossJoin(F.broadcast(total)).where(F.col("n") >= F.lit(_ITEM_SHARE) * F.col("all_rows"))
        out.append(frequent.select(F.lit(batch).cast("long").alias("batch"), "item", "n"))
    return sets.union_all(*out)


_SKETCHED = ["l_quantity", "l_extendedprice", "l_discount"]


@CASES.query(
    "stat_quantile_sketch",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", p AS at, count({c}) AS n, true AS within FROM lineitem, (SELECT unnest([0.1, 0.5, 0.9])::DOUBLE AS p) GROUP BY p"""
        for c in _SKETCHED
    ),
)
def quantile_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles from sketches of each line number, merged; ``within``: the exact rank of the value found is off by at most 2 %."""
    lines = table(spark, sf, "lineitem").select("l_linenumber", *_SKETCHED)
    merged = sketches.merged_sketches(sketches.quantile_sketches(lines, _SKETCHED, ["l_linenumber"]))
    points = F.array(*[F.struct(F.lit(p).alias("at"), sketches.quantile("sketch", p).alias("value")) for p in (0.1, 0.5, 0.9)])
    found = merged.select("column", F.kll_sketch_get_n_double("sketch").alias("n"), F.explode(points).alias("p"))
    found = found.select("column", "n", "p.*").collect()  # nine rows
    below = [F.count_if(F.col(r["column"]) < r["value"]).alias(f"b{i}") for i, r in enumerate(found)]
    upto = [F.count_if(F.col(r["column"]) <= r["value"]).alias(f"u{i}") for i, r in enumerate(found)]
    exact = lines.agg(*below, *upto).first()
    rows = [(r["column"], r["at"], r["n"], exact[f"b{i}"] - 0.02 * r["n"] <= r["at"] * r["n"] <= exact[f"u{i}"] + 0.02 * r["n"]) for i, r in enumerate(found)]
    return spark.createDataFrame(rows, "column string, at double, n long, within boolean")


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@CASES.query(
    "stat_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count({c}) AS DOUBLE) AS count, round(avg({c}), 4) AS mean,
                   round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
                   CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in _DESCRIBED
    ),
)
def describe(spark: SparkSession, sf: str) -> DataFrame:
    described = aggregate.describe(table(spark, sf, "lineitem"), _DESCRIBED)
    return described.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@CASES.query(
    "ord_by_value_desc",
    "SELECT count(*) AS n, user_id FROM events GROUP BY user_id ORDER BY n DESC, user_id",
)
def by_value_desc(spark: SparkSession, sf: str) -> DataFrame:
    counts = events(spark, sf).groupBy("user_id").agg(rows())
    return order.by_value_desc(counts, "n", ["user_id"])


@CASES.query("ord_by_field", "SELECT user_id, event_id FROM events ORDER BY user_id, event_id")
def by_field(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("user_id", "event_id").orderBy("user_id", "event_id")


@CASES.query(
    "ord_by_agg",
    """SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_suppkey ORDER BY total DESC, l_suppkey""",
)
def by_agg(spark: SparkSession, sf: str) -> DataFrame:
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return sums.orderBy(F.desc("total"), "l_suppkey")


@CASES.query(
    "ord_top_n",
    """SELECT l_linenumber AS "countryCode", count(*) AS n FROM lineitem
       GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5""",
)
def top_n(spark: SparkSession, sf: str) -> DataFrame:
    """Top five country codes by number of records, from raw call records."""
    records = clean.typed(cdr_text(spark, sf), schemas.CDR, empty_as_zero=True)
    counts = records.groupBy("countryCode").agg(rows())
    return order.top_n(counts, 5, ["n"], ["countryCode"])


@CASES.query(
    "ord_first",
    "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id LIMIT 1",
)
def first(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("event_id", "ts", "user_id").orderBy("ts", "event_id").limit(1)
