"""Sinks. Each query writes with the sink under test and returns what it wrote, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import scratch
from millrace.functions import text as X
from millrace.functions.times import wall
from millrace.plans.base import SLICED_EVENTS, Cases, events, table
from millrace.sinks import clients, files, outbox, tables
from millrace.sinks.upsert import UpsertLog
from millrace.sources import text
from millrace.plans.replay import SLICES, day_slices, replay, replay_batches

CASES = Cases()


@CASES.query("snk_text", "SELECT CAST(p_partkey AS VARCHAR) || '|' || p_name AS line FROM part")
def text_output(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "text")
    line = F.concat_ws("|", "p_partkey", "p_name").alias("value")
    files.text(table(spark, sf, "part").select(line), path)
    return text.lines(spark, path).select(F.col("value").alias("line"))


@CASES.query(
    "snk_text_per_batch",
    f"""WITH {SLICED_EVENTS}
        SELECT batch_id AS batch, CAST(event_id AS VARCHAR) || ',' || event_type AS line FROM sliced""",
)
def text_per_batch(spark: SparkSession, sf: str) -> DataFrame:
    prefix = f"{scratch.new_dir(spark, 'batches')}/trips"
    write = files.per_batch_text(prefix, "txt")
    replay_batches(
        events(spark, sf),
        "ts",
        lambda df, batch_id: write(df.select(X.csv_line("event_id", "event_type")), batch_id),
        "text-per-batch",
    )
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/trips-(\d+)\.txt/", 1)
    return text.lines(spark, f"{prefix}-*.txt").select(
        batch.cast("long").alias("batch"), F.col("value").alias("line")
    )


@CASES.query(
    "snk_parquet_per_batch",
    f"WITH {SLICED_EVENTS} SELECT batch_id AS batch, event_id, user_id, value FROM sliced",
)
def parquet_per_batch(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "typed")
    rows = events(spark, sf).select("event_id", "user_id", "value", "ts")
    replay_batches(rows, "ts", files.per_batch(path), "parquet-per-batch")
    return spark.read.parquet(path).select(
        F.col("batch_id").cast("long").alias("batch"), "event_id", "user_id", "value"
    )


@CASES.query("snk_kv_tsv", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def key_value_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "pairs")
    counts = events(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    files.key_value_lines(counts, path, "user_id", "n")
    return text.tab_typed(spark, path, "user_id long, n long")


@CASES.query(
    "snk_append_log",
    f"""WITH {SLICED_EVENTS}
        SELECT batch_id AS batch, strftime(ts, '%Y-%m-%d') AS timestamp, CAST(user_id AS VARCHAR) AS business_id,
               CASE WHEN value > 50 THEN 'good' ELSE 'bad' END AS rating
        FROM sliced""",
)
def append_log(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings log of three text fields, each field under its own name."""
    path = scratch.new_dir(spark, "log")
    append = files.per_batch(path)

    def log(df: DataFrame, batch_id: int) -> None:
        append(
            df.select(
                F.date_format("ts", "yyyy-MM-dd").alias("timestamp"),
                F.col("user_id").cast("string").alias("business_id"),
                F.when(F.col("value") > 50, "good").otherwise("bad").alias("rating"),
            ),
            batch_id,
        )

    replay_batches(events(spark, sf).select("ts", "user_id", "value"), "ts", log, "append-log")
    return spark.read.parquet(path).select(
        F.col("batch_id").cast("long").alias("batch"), "timestamp", "business_id", "rating"
    )


class _Counting:
    """Stands in for a message client: takes messages, keeps nothing."""

    def send(self, message: str) -> None:
        pass

    def close(self) -> None:
        pass


@CASES.query(
    "snk_foreach_writer",
    f"""WITH {SLICED_EVENTS}
        SELECT batch_id AS batch, count(*) AS sent,
               CAST(sum(length(CAST(event_id AS VARCHAR) || ',' || event_type || ',' || CAST(user_id AS VARCHAR))) AS BIGINT) AS sent_chars
        FROM sliced GROUP BY batch_id""",
)
def client_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "receipts")
    store = files.per_batch(path)

    def send(df: DataFrame, batch_id: int) -> None:
        messages = df.select(X.csv_line("event_id", "event_type", "user_id").alias("message"))
        store(clients.deliver(messages, "message", _Counting), batch_id)

    replay_batches(
        events(spark, sf).select("event_id", "event_type", "user_id", "ts"), "ts", send, "client-sink"
    )
    return (
        spark.read.parquet(path)
        .groupBy(F.col("batch_id").cast("long").alias("batch"))
        .agg(F.sum("sent").alias("sent"), F.sum("sent_chars").alias("sent_chars"))
    )


@CASES.query(
    "snk_outbox",
    f"""WITH {SLICED_EVENTS},
             sent AS (SELECT batch_id AS batch, CAST(event_id AS VARCHAR) || ',' || event_type || ',' || CAST(user_id AS VARCHAR) AS message FROM sliced)
        SELECT batch, message, count(*) OVER (PARTITION BY batch) AS sent, CAST(sum(length(message)) OVER (PARTITION BY batch) AS BIGINT) AS sent_chars
        FROM sent""",
)
def outbox_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Messages in published batches, with the receipts of their batch."""
    path = scratch.new_dir(spark, "outbox")
    rows = events(spark, sf).select(X.csv_line("event_id", "event_type", "user_id").alias("message"), "ts")
    replay(spark, {"rows": day_slices(rows, "ts")}, lambda rows: outbox.writer(rows, "message", path), "outbox")
    totals = outbox.receipts(spark, path).groupBy("batch").agg(F.sum("sent").alias("sent"), F.sum("sent_chars").alias("sent_chars"))
    return outbox.messages(spark, path).join(totals, "batch").select("batch", "message", "sent", "sent_chars")


@CASES.query(
    "snk_keyed_upsert",
    """SELECT user_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value
       FROM events GROUP BY user_id""",
)
def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    store = UpsertLog(scratch.new_dir(spark, "latest"), ("user_id",), fold_every=2)
    rows = events(spark, sf).select("user_id", "ts", "event_type", "value")
    store.create_if_missing(spark, rows.schema)
    replay_batches(
        rows, "ts", lambda df, batch_id: store.write(df, batch_id, order=["ts"]), "keyed-upsert"
    )
    return store.read(spark)


@CASES.query(
    "snk_parquet_json",
    """SELECT fmt, c_custkey, c_name, c_acctbal FROM customer, (VALUES ('parquet'), ('json')) f(fmt)""",
)
def file_formats(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    found = []
    for fmt in ("parquet", "json"):
        path = scratch.new_dir(spark, fmt)
        rows.write.format(fmt).save(path)
        read = spark.read.schema(rows.schema).format(fmt).load(path)
        found.append(read.withColumn("fmt", F.lit(fmt)))
    return found[0].unionByName(found[1])


@CASES.query(
    "snk_table_per_batch",
    f"""WITH {SLICED_EVENTS}
        SELECT batch_id AS batch, event_type, count(*) AS n FROM sliced GROUP BY ALL""",
)
def table_per_batch(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "tables")
    prefix = path.rsplit("/", 1)[-1].replace("-", "_")
    save = tables.per_batch(prefix, path)

    def write(df: DataFrame, batch_id: int) -> None:
        save(df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), batch_id)

    replay_batches(events(spark, sf).select("event_type", "ts"), "ts", write, "table-per-batch")
    names = [f"{prefix}_{i}" for i in range(SLICES)]
    found = [
        spark.table(name).withColumn("batch", F.lit(i).cast("long")) for i, name in enumerate(names)
    ]
    for name in names:
        spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return text.merged([lambda df=df: df for df in found])


@CASES.query(
    "snk_append_mode",
    "SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def append_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts appended to one path, one append per range of days."""
    path = scratch.new_dir(spark, "counts")
    day = wall(F.date_trunc("day", "ts")).alias("day")
    for part in day_slices(events(spark, sf).select("ts", "event_type"), "ts"):
        files.append(part.groupBy(day, "event_type").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.parquet(path)
