"""Streaming queries: the events arrive in three ranges of days, oldest first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace import scratch
from millrace.functions import text as X
from millrace.plans.base import SLICED_EVENTS, Cases, events, quotes
from millrace.sinks.files import latest, per_batch
from millrace.sinks.upsert import UpsertLog
from millrace.operators import sets
from millrace.streaming import batches, inactivity, state, windows
from millrace.plans.replay import SLICES, day_bounds, day_slices, drain, replay, replay_batches, slices_between

CASES = Cases()


def _changes(spark: SparkSession, slices: list[DataFrame], keys: tuple[str, ...], label: str, plan) -> DataFrame:
    """Run ``plan`` in update mode; each batch stores the rows that changed, a reader takes the newest."""
    store = UpsertLog(scratch.new_dir(spark, label), keys)
    replay(
        spark,
        {"rows": slices},
        lambda rows: plan(rows).writeStream.outputMode("update").foreachBatch(
            lambda df, batch_id: store.write(df, batch_id)
        ),
        label,
    )
    return store.read(spark)


@CASES.query(
    "st_tumbling",
    "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def tumbling(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("ts", "event_type")
    return _changes(
        spark,
        day_slices(rows, "ts"),
        ("window_start", "event_type"),
        "tumbling",
        lambda df: windows.tumbling_counts(
            windows.watermarked(df, "ts", "1 hour"), "ts", ["event_type"], "1 hour"
        ),
    )


@CASES.query(
    "st_sliding_avg",
    """SELECT CAST(date_trunc('hour', ts) - to_hours(back) AS TIMESTAMP) AS window_start, event_type AS symbol,
              round(sum(value * 10), 4) AS window_sum, round(sum(value * 10) / 2, 4) AS per_slide,
              round(avg(value * 10), 6) AS window_avg
       FROM events, (VALUES (0), (1)) b(back) GROUP BY 1, 2""",
)
def sliding_avg(spark: SparkSession, sf: str) -> DataFrame:
    rows = quotes(spark, sf).select("ts", "symbol", "price")
    averages = _changes(
        spark,
        day_slices(rows, "ts"),
        ("window_start", "symbol"),
        "sliding",
        lambda df: windows.sliding_average(
            windows.watermarked(df, "ts", "1 hour"), "ts", ["symbol"], "price", "2 hours", "1 hour", 2
        ),
    )
    return averages.withColumns(
        {
            "window_sum": F.round("window_sum", 4),
            "per_slide": F.round("per_slide", 4),
            "window_avg": F.round("window_avg", 6),
        }
    )


@CASES.query("st_running_count", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def running_count(spark: SparkSession, sf: str) -> DataFrame:
    """Complete mode: every user is emitted in every batch. Files keep no order, so readers sort."""
    path = scratch.new_dir(spark, "running-count")
    rows = events(spark, sf).select("user_id", "ts")
    replay(
        spark,
        {"rows": day_slices(rows, "ts")},
        lambda rows: state.running_counts(rows, ["user_id"])
        .writeStream.outputMode("complete")
        .foreachBatch(per_batch(path)),
        "running-count",
    )
    return latest(spark, path)


@CASES.query("st_state_read", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def state_read(spark: SparkSession, sf: str) -> DataFrame:
    """The running counts out of the state of an update-mode query whose output goes nowhere."""
    landing, checkpoint = scratch.new_dir(spark, "state-in"), scratch.new_dir(spark, "state-checkpoint")
    for rows in day_slices(events(spark, sf).select("user_id", "ts"), "ts"):
        rows.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        drain(state.running_counts(stream, ["user_id"]).writeStream.outputMode("update").format("noop"), checkpoint)
    return state.read_back(spark, checkpoint).select("user_id", F.col("count").alias("n"))


@CASES.query(
    "st_running_stats",
    """SELECT event_type AS symbol, min(CAST(props->>'$.k' AS BIGINT)) AS low, max(CAST(props->>'$.k' AS BIGINT)) AS high,
              count(*) FILTER (WHERE value * 10 > 500) AS over
       FROM events GROUP BY event_type""",
)
def running_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = quotes(spark, sf)
    return _changes(
        spark,
        day_slices(rows, "ts"),
        ("symbol",),
        "running-stats",
        lambda df: state.stats_by_key(df, ["symbol"], "volume", "price", 500.0),
    )


_RESET_ABOVE = 1000
_ALARM_STEPS = ",\n".join(
    f"""s{i} AS (SELECT {i} AS batch_id, min(k) FILTER (WHERE batch_id <= {i}) AS low,
                        max(k) FILTER (WHERE batch_id <= {i}) AS high,
                        count(*) FILTER (WHERE batch_id = {i} AND value * 10 > 500)
                        {f"+ (SELECT CASE WHEN reached > {_RESET_ABOVE} THEN 0 ELSE reached END FROM s{i - 1})" if i else ""} AS reached
                 FROM sliced)"""
    for i in range(3)
)


@CASES.query(
    "st_global_alarm",
    f"""WITH {SLICED_EVENTS}, {_ALARM_STEPS}
        SELECT CAST(batch_id AS BIGINT) AS batch, CAST(low AS BIGINT) AS low, CAST(high AS BIGINT) AS high,
               CAST(reached AS BIGINT) AS reached, reached > {_RESET_ABOVE} AS alarm
        FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2)""",
)
def global_alarm(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "alarm")
    step = state.threshold_alarm(path, "volume", "price", 500.0, _RESET_ABOVE)
    replay_batches(quotes(spark, sf), "ts", step, "alarm")
    return spark.read.parquet(path).select(
        F.col("batch_id").cast("long").alias("batch"), "low", "high", "reached", "alarm"
    )


@CASES.query(
    "st_cumulative_exclusive",
    f"""WITH {SLICED_EVENTS},
             v AS (SELECT *, CAST(user_id AS VARCHAR) || ':' || strftime(ts, '%Y-%m-%d') AS visit FROM sliced),
             per AS (SELECT batch_id,
                count(*) FILTER (WHERE event_type IN ('click', 'view') AND (batch_id, visit) NOT IN
                    (SELECT (batch_id, visit) FROM v WHERE event_type IN ('signup', 'error'))) AS one,
                count(*) FILTER (WHERE event_type IN ('signup', 'error') AND (batch_id, visit) NOT IN
                    (SELECT (batch_id, visit) FROM v WHERE event_type IN ('click', 'view'))) AS two
                FROM v GROUP BY batch_id)
        SELECT batch_id AS batch, CAST(sum(one) OVER (ORDER BY batch_id) AS BIGINT) AS search_only,
               CAST(sum(two) OVER (ORDER BY batch_id) AS BIGINT) AS social_only
        FROM per""",
)
def cumulative_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "exclusive")
    visit = X.joined_key(F.col("user_id"), F.date_format("ts", "yyyy-MM-dd")).alias("visit")
    step = batches.exclusive_counts(
        path, "event_type", ["click", "view"], ["signup", "error"], "visit", "event_id"
    )
    rows = events(spark, sf).select("event_id", "event_type", visit, "ts")
    replay_batches(rows, "ts", step, "exclusive")
    so_far = Window.orderBy("batch_id")  # one row per batch
    return spark.read.parquet(path).select(
        F.col("batch_id").cast("long").alias("batch"),
        F.sum("only_first").over(so_far).alias("search_only"),
        F.sum("only_second").over(so_far).alias("social_only"),
    )


@CASES.query(
    "st_session_count",
    """WITH marked AS (SELECT user_id, value > 50 AS good, ts,
                       CASE WHEN ts > lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS opens
                       FROM events WINDOW w AS (PARTITION BY user_id, value > 50 ORDER BY ts)),
            numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id, good ORDER BY ts) AS s FROM marked)
       SELECT user_id, good, min(ts) AS session_start, CAST(max(ts) + INTERVAL 6 HOUR AS TIMESTAMP) AS session_end, count(*) AS n
       FROM numbered GROUP BY user_id, good, s
       HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def session_count(spark: SparkSession, sf: str) -> DataFrame:
    """Closed sessions per user and rating: those the watermark has passed."""
    path = scratch.new_dir(spark, "sessions")
    rows = events(spark, sf).select("user_id", (F.col("value") > 50).alias("good"), "ts")
    replay(
        spark,
        {"rows": day_slices(rows, "ts")},
        lambda rows: windows.session_counts(
            windows.watermarked(rows, "ts", "1 hour"), "ts", ["user_id", "good"], "6 hours"
        )
        .writeStream.outputMode("append")
        .foreachBatch(per_batch(path)),
        "sessions",
    )
    return spark.read.parquet(path).drop("batch_id")


@CASES.query(
    "st_inactivity",
    f"""WITH {SLICED_EVENTS}
        SELECT user_id, value > 50 AS good, count(*) AS n FROM sliced GROUP BY user_id, value > 50, batch_id""",
)
def inactivity_count(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings per user that end after a millisecond without any: a count that a batch does not go on with has ended before the next.

    The last run goes on until the timers have ended every count.
    """
    landing, out, checkpoint = (scratch.new_dir(spark, f"inactivity-{name}") for name in ("in", "out", "checkpoint"))
    slices = day_slices(events(spark, sf).select("user_id", (F.col("value") > 50).alias("good"), "ts"), "ts")

    def writer():
        rows = spark.readStream.schema(slices[0].schema).parquet(landing)
        counts = inactivity.idle_counts(rows, ["user_id", "good"], 1)
        return counts.writeStream.outputMode("append").format("parquet").option("path", out)

    for rows in slices:
        rows.write.mode("append").parquet(landing)
        if rows is slices[-1]:
            inactivity.run_out(writer(), checkpoint)
        else:
            with inactivity.batches_with_data_only(spark):
                drain(writer(), checkpoint)
    return spark.read.parquet(out).select("user_id", "good", "n")


@CASES.query(
    "st_two_streams",
    f"""WITH {SLICED_EVENTS},
             one AS (SELECT batch_id, user_id, event_id FROM sliced WHERE event_type IN ('click', 'view')),
             two AS (SELECT batch_id, user_id, value FROM sliced WHERE event_type IN ('signup', 'error')),
             meet AS (SELECT batch_id, user_id, count(event_id) AS shown, count(value) AS signed, max(value) AS most
                      FROM (SELECT batch_id, user_id, event_id, NULL::DOUBLE AS value FROM one
                            UNION ALL SELECT batch_id, user_id, NULL, value FROM two) GROUP BY ALL)
        SELECT batch_id AS batch, user_id, shown, signed, signed = 0 AS only_shown, most FROM meet""",
)
def two_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams of different columns; per batch, what each user has on either side, and who is on the first side only."""
    path = scratch.new_dir(spark, "two-streams")
    store = per_batch(path)
    rows = events(spark, sf)
    shown = rows.where(F.col("event_type").isin("click", "view")).select("user_id", "event_id", "ts")
    signed = rows.where(F.col("event_type").isin("signup", "error")).select("user_id", "value", "ts")
    bounds = day_bounds(rows, "ts", SLICES)

    def step(first: DataFrame, second: DataFrame, batch_id: int) -> None:
        one = first.groupBy("user_id").agg(F.count("event_id").alias("shown"))
        two = second.groupBy("user_id").agg(F.count("value").alias("signed"), F.max("value").alias("most"))
        alone = sets.subtract(first.select("user_id"), second.select("user_id")).withColumn("only_shown", F.lit(True))
        joined = one.join(two, "user_id", "full").join(alone, "user_id", "left")
        store(joined.fillna({"shown": 0, "signed": 0, "only_shown": False}), batch_id)

    replay(
        spark,
        {"first": slices_between(shown, "ts", bounds), "second": slices_between(signed, "ts", bounds)},
        lambda first, second: batches.two_streams(first, second).writeStream.foreachBatch(batches.on_both(step)),
        "two-streams",
    )
    found = spark.read.parquet(path)
    return found.select(F.col("batch_id").cast("long").alias("batch"), "user_id", "shown", "signed", "only_shown", "most")


@CASES.query(
    "st_foreach_batch",
    f"""WITH {SLICED_EVENTS}
        SELECT batch_id AS batch, count(*) AS n, count(DISTINCT user_id) AS users, max(ts) AS batch_time
        FROM sliced GROUP BY batch_id""",
)
def foreach_batch(spark: SparkSession, sf: str) -> DataFrame:
    """An arbitrary batch function with the batch number and the time the batch reaches to."""
    path = scratch.new_dir(spark, "summaries")
    store = per_batch(path)

    def summarise(df: DataFrame, batch_id: int) -> None:
        summary = df.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("user_id").alias("users"),
            F.max("ts").alias("batch_time"),
        )
        store(summary, batch_id)

    replay_batches(events(spark, sf).select("user_id", "ts"), "ts", summarise, "summaries")
    return spark.read.parquet(path).select(
        F.col("batch_id").cast("long").alias("batch"), "n", "users", "batch_time"
    )


@CASES.query(
    "st_late_dropped",
    f"""WITH {SLICED_EVENTS}
        SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n
        FROM sliced WHERE batch_id <> 1 GROUP BY ALL""",
)
def late_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """The middle range of days arrives last, behind the watermark, and must not be counted."""
    oldest, middle, newest = day_slices(events(spark, sf).select("ts", "event_type"), "ts")
    return _changes(
        spark,
        [oldest, newest, middle],
        ("window_start", "event_type"),
        "late",
        lambda df: windows.tumbling_counts(
            windows.watermarked(df, "ts", "1 hour"), "ts", ["event_type"], "1 hour"
        ),
    )
