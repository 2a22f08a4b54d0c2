"""Joins, set operations, samples and user functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import scratch
from millrace.functions import text as X
from millrace.operators import joins, sampling, sets, udf
from millrace.plans.base import SLICED_EVENTS, Cases, events, k_of_props, quotes, table
from millrace.sinks.files import per_batch
from millrace.streaming import batches
from millrace.streaming.joins import enrich, within
from millrace.plans.replay import day_slices, replay, replay_batches
from millrace.streaming.windows import watermarked

CASES = Cases()


@CASES.query(
    "join_inner",
    """SELECT e.event_id, e.user_id AS channel, c.c_mktsegment AS industry
       FROM events e JOIN customer c ON c.c_custkey = e.user_id""",
)
def inner(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the industry of their channel; the list of channels is keyed by a URL segment."""
    url = F.concat(F.lit("http://www.example.com/r/"), F.col("c_custkey"))
    popular = table(spark, sf, "customer").select(
        F.split(url, "/")[4].cast("long").alias("channel"), F.col("c_mktsegment").alias("industry")
    )
    rows = events(spark, sf).select("event_id", F.col("user_id").alias("channel"))
    return joins.inner(rows, popular, ["channel"], spread_by=["event_id"])


@CASES.query(
    "join_stream_interval",
    """SELECT event_id, ts AS shown_at, CAST(ts + to_minutes(CAST(props->>'$.k' AS INTEGER)) AS TIMESTAMP) AS seen_at
       FROM events WHERE CAST(props->>'$.k' AS INTEGER) <= 60""",
)
def stream_interval(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams: an event and the answer to it, which counts when it comes within the hour."""
    shown = events(spark, sf).select("event_id", F.col("ts").alias("shown_at"))
    answers = events(spark, sf).select(
        F.col("event_id").alias("answer_to"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), k_of_props())).alias("seen_at"),
    )
    out = scratch.new_dir(spark, "interval-join")

    def build(left: DataFrame, right: DataFrame):
        joined = within(
            watermarked(left, "shown_at", "2 hours"),
            watermarked(right, "seen_at", "2 hours"),
            "event_id",
            "answer_to",
            "shown_at",
            "seen_at",
            "1 hour",
        )
        return joined.drop("answer_to").writeStream.format("parquet").option("path", out)

    replay(
        spark,
        {"left": day_slices(shown, "shown_at"), "right": day_slices(answers, "seen_at")},
        build,
        "interval-join",
    )
    rows = spark.read.parquet(out)
    return rows.select(
        "event_id",
        F.col("shown_at").cast("timestamp_ntz").alias("shown_at"),
        F.col("seen_at").cast("timestamp_ntz").alias("seen_at"),
    )


@CASES.query(
    "join_cogroup",
    """WITH t AS (SELECT user_id, event_id, event_type = 'view' AS v FROM events WHERE event_type IN ('view', 'purchase')),
            n AS (SELECT user_id, count(*) AS n FROM t GROUP BY user_id)
       SELECT t.user_id, CAST(CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % CAST(ceil(n / 32.0) AS BIGINT) AS BIGINT) AS chunk,
              coalesce(string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY event_id) FILTER (WHERE v), '') AS views,
              coalesce(string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY event_id) FILTER (WHERE NOT v), '') AS purchases
       FROM t JOIN n ON n.user_id = t.user_id GROUP BY 1, 2""",
)
def cogroup(spark: SparkSession, sf: str) -> DataFrame:
    """Views and purchases of a user side by side, in chunks of about 32 values."""
    rows = events(spark, sf).withColumn("v", F.col("event_id"))
    groups = joins.cogroup(
        rows.where(F.col("event_type") == "view"),
        rows.where(F.col("event_type") == "purchase"),
        "user_id",
        "v",
        "event_id",
        chunk_rows=32,
    )
    return groups.select(
        "user_id",
        "chunk",
        F.array_join(F.col("left_values").cast("array<string>"), " ").alias("views"),
        F.array_join(F.col("right_values").cast("array<string>"), " ").alias("purchases"),
    )


@CASES.query(
    "join_stream_static",
    """SELECT event_id, c_name, c_nationkey FROM events JOIN customer ON c_custkey = user_id""",
)
def stream_static(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey"
    )
    path = scratch.new_dir(spark, "static-join")
    rows = events(spark, sf).select("event_id", "user_id", "ts")
    step = enrich(people, ["user_id"], ["event_id"], per_batch(path))
    replay_batches(rows, "ts", step, "static-join")
    return spark.read.parquet(path).select("event_id", "c_name", "c_nationkey")


def _visit() -> Column:
    return X.joined_key(F.col("user_id"), F.date_format("ts", "yyyy-MM-dd"))


@CASES.query(
    "join_left_anti",
    """WITH v AS (SELECT event_id, event_type, CAST(user_id AS VARCHAR) || ':' || strftime(ts, '%Y-%m-%d') AS visit FROM events)
       SELECT 'search' AS channel, event_id FROM v WHERE event_type IN ('click', 'view')
          AND visit NOT IN (SELECT visit FROM v WHERE event_type IN ('signup', 'error'))
       UNION ALL
       SELECT 'social', event_id FROM v WHERE event_type IN ('signup', 'error')
          AND visit NOT IN (SELECT visit FROM v WHERE event_type IN ('click', 'view'))""",
)
def left_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Visits reached through one kind of referrer only, in both directions, duplicates kept."""
    rows = events(spark, sf).select("event_id", "event_type", _visit().alias("visit"))
    channel = F.when(F.col("event_type").isin("click", "view"), "search").when(
        F.col("event_type").isin("signup", "error"), "social"
    )
    sided = rows.withColumn("channel", channel).where("channel IS NOT NULL")
    return joins.exclusive_sides(sided, "channel", ["visit"], spread_by=["event_id"]).select("channel", "event_id")


@CASES.query(
    "join_left_outer",
    """SELECT c_custkey, round(coalesce(sum(o_totalprice), 0.0), 2) AS spent
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def left_outer(spark: SparkSession, sf: str) -> DataFrame:
    spent = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum("o_totalprice").alias("spent"))
    )
    people = table(spark, sf, "customer").select("c_custkey")
    joined = joins.left_outer_default(people, spent, ["c_custkey"], {"spent": 0.0})
    return joined.withColumn("spent", F.round("spent", 2))


#: code of a customer's nation; codes of customers in debt are in no table
_CODE = "c_nationkey + CASE WHEN c_acctbal < 0 THEN 100 ELSE 0 END"
_NAMED = f"""SELECT c_custkey, coalesce(r_name, 'NotFound') AS name
             FROM (SELECT c_custkey, {_CODE} AS code FROM customer)
             LEFT JOIN nation ON n_nationkey = code LEFT JOIN region ON r_regionkey = n_regionkey"""


@CASES.query("join_lookup_chain", _NAMED)
def lookup_chain(spark: SparkSession, sf: str) -> DataFrame:
    facts = table(spark, sf, "customer").select("c_custkey", F.expr(_CODE).alias("code"))
    first = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("code"), F.col("n_regionkey").alias("via")
    )
    second = table(spark, sf, "region").select(F.col("r_regionkey").alias("via"), F.col("r_name").alias("name"))
    named = joins.lookup_chain(facts, first, second, "code", "via", "name", spread_by=["c_custkey"])
    return named.select("c_custkey", "name")


@CASES.query("udf_lookup", _NAMED)
def udf_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The same chain as a function registered for SQL."""
    first = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    second = table(spark, sf, "region").select("r_regionkey", "r_name")
    udf.register_lookup(spark, "country_name", first, second)
    return spark.sql(
        f"SELECT c_custkey, country_name({_CODE}) AS name FROM {{customer}}",
        customer=table(spark, sf, "customer"),
    )


@CASES.query(
    "udf_aggregate",
    """SELECT event_type AS symbol, min(CAST(props->>'$.k' AS BIGINT)) AS low, max(CAST(props->>'$.k' AS BIGINT)) AS high,
              count(*) FILTER (WHERE value * 10 > 500) AS over
       FROM events GROUP BY event_type""",
)
def udf_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    stats = udf.running_stats_udaf(quotes(spark, sf), "symbol", "volume", "price", 500.0)
    return stats.withColumnRenamed("key", "symbol")


@CASES.query("udf_pipe", "SELECT upper(p_name) AS line FROM part")
def udf_pipe(spark: SparkSession, sf: str) -> DataFrame:
    return udf.pipe_lines(table(spark, sf, "part"), "p_name", "tr a-z A-Z")


@CASES.query(
    "set_union_all",
    """SELECT event_id, event_type FROM events UNION ALL SELECT event_id, event_type FROM events""",
)
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("event_id", "event_type")
    return sets.union_all(rows, rows)


def _pairs(df: DataFrame) -> DataFrame:
    """The distinct (user, type) pairs of a batch."""
    return df.select("user_id", "event_type").distinct()


def _with_previous(spark: SparkSession, sf: str, combine, label: str) -> DataFrame:
    path = scratch.new_dir(spark, label)
    rows = events(spark, sf).select("user_id", "event_type", "ts")
    replay_batches(rows, "ts", batches.with_previous(path, _pairs, combine), label)
    return spark.read.parquet(f"{path}/out").select(
        F.col("batch_id").cast("long").alias("batch"), "user_id", "event_type"
    )


_BATCH_PAIRS = f"""{SLICED_EVENTS}, pairs AS (SELECT DISTINCT batch_id, user_id, event_type FROM sliced)"""


def _prev_sql(op: str) -> str:
    return f"""WITH {_BATCH_PAIRS}
        SELECT * FROM (SELECT batch_id AS batch, user_id, event_type FROM pairs WHERE batch_id > 0
        {op} SELECT batch_id + 1 AS batch, user_id, event_type FROM pairs WHERE batch_id < 2)
        WHERE batch IN (SELECT batch_id FROM pairs)"""


@CASES.query("set_union_prev", _prev_sql("UNION ALL"))
def union_prev(spark: SparkSession, sf: str) -> DataFrame:
    return _with_previous(spark, sf, sets.union_all, "union-previous")


@CASES.query("set_intersect", _prev_sql("INTERSECT"))
def intersect_prev(spark: SparkSession, sf: str) -> DataFrame:
    return _with_previous(spark, sf, sets.intersect, "intersect-previous")


@CASES.query("set_except", _prev_sql("EXCEPT"))
def except_prev(spark: SparkSession, sf: str) -> DataFrame:
    return _with_previous(spark, sf, sets.subtract, "except-previous")


@CASES.query(
    "set_except_both",
    """WITH a AS (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem WHERE l_discount > 0.05),
            b AS (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem WHERE l_tax > 0.05 AND l_quantity > 40)
       SELECT 'first' AS side, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
       UNION ALL SELECT 'second', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def except_both(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    a = lines.where("l_discount > 0.05").select("l_suppkey", "l_linenumber")
    b = lines.where("l_tax > 0.05 AND l_quantity > 40").select("l_suppkey", "l_linenumber")
    return sets.differences(a, b)


@CASES.query(
    "smp_sample",
    """SELECT event_id, event_type FROM events
       WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000000 < 700000""",
)
def sample(spark: SparkSession, sf: str) -> DataFrame:
    """A hashed 70 % sample."""
    return sampling.hashed(events(spark, sf).select("event_id", "event_type"), ["event_id"], 0.7)


@CASES.query("smp_replaced", "SELECT event_type, true AS near, true AS known FROM events GROUP BY event_type")
def sample_with_replacement(spark: SparkSession, sf: str) -> DataFrame:
    """Per type, whether a sample with replacement of the table's size has about its share (eight deviations), of its rows only."""
    rows = events(spark, sf).select("event_id", "event_type")
    drawn = sampling.with_replacement(rows, 1.0, seed=7).groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("times"))
    both = rows.withColumn("there", F.lit(1)).join(drawn, ["event_id", "event_type"], "full")
    per_type = both.groupBy("event_type").agg(
        F.sum("there").alias("n"), F.sum(F.coalesce("times", F.lit(0))).alias("m"), F.bool_and(F.col("there").isNotNull()).alias("known")
    )
    return per_type.select("event_type", (F.abs(F.col("m") - F.col("n")) <= 8 * F.sqrt("n") + 1).alias("near"), "known")


@CASES.query(
    "smp_split",
    "SELECT event_id, CASE WHEN event_id % 10 < 3 THEN 'test' ELSE 'train' END AS part FROM events",
)
def split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.label_split(events(spark, sf), "event_id", 3, 10).select("event_id", "part")
