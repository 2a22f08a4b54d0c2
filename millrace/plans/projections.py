"""Projections, filters, cleaning and null handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import clean, times, vectors
from millrace.functions import text as X
from millrace.operators import nulls, project, variables
from millrace.plans.base import Cases, cdr_text, events, k_of_props, table
from millrace.plans.sourcing import landed_dictionary
from millrace.sources import dictionary, documents

CASES = Cases()

LINEITEM_CDR = """
    SELECT CAST(l_suppkey AS INTEGER) AS "squareId", epoch_ms(l_shipdate) AS "timeInterval",
           l_linenumber AS "countryCode",
           CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS sms_in,
           CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_discount END AS sms_out,
           l_tax AS call_in, l_extendedprice AS internet
    FROM lineitem"""


@CASES.query(
    "prj_translate",
    """SELECT p_partkey,
              array_to_string(list_transform(string_split(p_name, ' '), lambda w: reverse(w)), ' ') AS translated
       FROM part""",
)
def translate(spark: SparkSession, sf: str) -> DataFrame:
    words = dictionary.dictionary(spark, landed_dictionary(spark, sf), "German")
    return project.translate(table(spark, sf, "part"), "p_partkey", "p_name", words)


@CASES.query("prj_key_by_day", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_id FROM events")
def key_by_day(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.unix_timestamp(times.instant(F.col("ts")))
    return events(spark, sf).select(times.day_of_epoch_seconds(seconds).alias("day"), "event_id")


@CASES.query("prj_map_partitions", "SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def map_partitions(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("event_id", F.unix_timestamp(times.instant(F.col("ts"))).alias("s"))
    return project.key_by_day_in_batches(rows, "event_id", "s")


#: SQL text: the blank-separated tokens of a text without trailing empty ones
TOKENS = """CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN CAST([] AS VARCHAR[])
                 ELSE string_split(rtrim(text, ' '), ' ') END"""


@CASES.query(
    "prj_tokens_array",
    f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, '|') AS tokens
        FROM (SELECT doc_id, {TOKENS} AS t FROM documents)""",
)
def tokens_array(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", X.tokens("text").alias("t"))
    return docs.select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", "|").alias("tokens")
    )


@CASES.query(
    "prj_tokens_flat",
    f"""SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS token
        FROM (SELECT doc_id, {TOKENS} AS t FROM documents)""",
)
def tokens_flat(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.posexplode(X.tokens("text")).alias("pos", "token"))


@CASES.query("flt_eq", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'")
def equality(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).where(F.col("event_type") == "purchase").select("event_id", "user_id")


@CASES.query("prj_select", "SELECT l_suppkey, l_shipdate, l_linenumber FROM lineitem")
def select(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_suppkey", F.col("l_shipdate"), "l_linenumber")


@CASES.query(
    "flt_sql_string", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F' AND o_totalprice > 100000"
)
def sql_string(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .where("o_orderstatus <> 'F' AND o_totalprice > 100000")
        .select("o_orderkey", "o_totalprice")
    )


@CASES.query(
    "flt_in_set", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'signup')"
)
def in_set(spark: SparkSession, sf: str) -> DataFrame:
    kept = F.col("event_type").isin("click", "view", "signup")
    return events(spark, sf).where(kept).select("event_id", "event_type")


@CASES.query(
    "prj_drop",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
              l_returnflag, l_linestatus, l_shipdate FROM lineitem""",
)
def drop(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").drop("l_linenumber")


@CASES.query(
    "prj_with_column",
    """SELECT l_orderkey, l_linenumber, l_shipdate + INTERVAL 10 MINUTE AS end_time, l_quantity / 2048 AS scaled
       FROM lineitem""",
)
def with_column(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .withColumn("end_time", F.col("l_shipdate") + F.expr("interval 10 minutes"))
        .withColumn("scaled", F.col("l_quantity") / 2048)
        .select("l_orderkey", "l_linenumber", "end_time", "scaled")
    )


@CASES.query(
    "prj_rename", "SELECT l_suppkey AS c0, l_linenumber AS c1, l_extendedprice AS c2 FROM lineitem"
)
def rename(spark: SparkSession, sf: str) -> DataFrame:
    names = ["l_suppkey", "l_linenumber", "l_extendedprice"]
    renamed = {name: f"c{i}" for i, name in enumerate(names)}
    return table(spark, sf, "lineitem").select(*names).withColumnsRenamed(renamed)


def _any(last: int) -> str:
    return f"len(list_filter(embedding[19:{last}], lambda x: CAST(x AS DOUBLE) > CAST(0.2 AS DOUBLE))) > 0"


@CASES.query(
    "flt_exists_slice",
    f"""SELECT vec_id, label, {_any(28)} AS ten_channels FROM embeddings WHERE {_any(29)}""",
)
def exists_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Ten channels from position 18 on, and the variant with eleven."""
    channels = F.col("embedding").cast("array<double>")
    return (
        table(spark, sf, "embeddings")
        .where(vectors.any_above(channels, 18, 11, 0.2))
        .select("vec_id", "label", vectors.any_above(channels, 18, 10, 0.2).alias("ten_channels"))
    )


@CASES.query(
    "flt_any_column",
    """SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount > 0.07 OR l_tax > 0.07""",
)
def any_column(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .where(vectors.any_column_above(["l_discount", "l_tax"], 0.07))
        .select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    )


@CASES.query(
    "prj_relabel",
    """SELECT event_id, CASE WHEN starts_with(event_type, 'c') THEN event_type ELSE 'site' END AS referrer,
              CASE WHEN value > 50 THEN 'good' ELSE 'bad' END AS rating
       FROM events""",
)
def relabel(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return events(spark, sf).select(
        "event_id",
        F.when(kind.startswith("c"), kind).otherwise("site").alias("referrer"),
        F.when(F.col("value") > 50, "good").otherwise("bad").alias("rating"),
    )


#: business records made of events: every fifth key lacks the Wi-Fi attribute
def _business(spark: SparkSession, sf: str) -> DataFrame:
    wifi = F.when(k_of_props() % 5 != 0, F.col("event_type"))
    attributes = F.struct(wifi.alias("Wi-Fi"))
    return events(spark, sf).select(
        "event_id", F.to_json(F.struct(attributes.alias("attributes"), F.col("value").alias("stars"))).alias("doc")
    )


@CASES.query(
    "flt_json_path",
    """SELECT event_id, event_type AS wifi, value AS stars FROM events WHERE CAST(props->>'$.k' AS INTEGER) % 5 <> 0""",
)
def json_path(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents.parsed(_business(spark, sf), "doc", schemas.BUSINESS, "b")
    wifi = F.col("b.attributes.Wi-Fi")
    return rows.where(wifi.isNotNull()).select("event_id", wifi.alias("wifi"), "b.stars")


@CASES.query(
    "prj_json_subset",
    """SELECT CAST(o_orderkey AS INTEGER) AS id, o_orderpriority AS "stationName", o_orderstatus AS "statusValue"
       FROM orders WHERE o_orderstatus <> 'F'""",
)
def json_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Stations out of service: fields are taken by name, whatever their order in the document."""
    status = F.col("o_orderstatus")
    station = F.struct(
        F.when(status == "F", 1).otherwise(3).alias("statusKey"),
        status.alias("statusValue"),
        F.col("o_orderpriority").alias("stationName"),
        F.lit(0).alias("availableDocks"),
        F.col("o_orderkey").alias("id"),
    )
    raw = table(spark, sf, "orders").select(F.to_json(station).alias("doc"))
    schema = "id int, stationName string, statusValue string, statusKey int"
    rows = documents.parsed(raw, "doc", schema, "s")
    return rows.where("s.statusKey <> 1").select("s.id", "s.stationName", "s.statusValue")


@CASES.query(
    "prj_parent_into_child",
    """SELECT strftime(min(ts) OVER (PARTITION BY event_id // 16), '%Y-%m-%d %H:%M:%S') || ',' || event_type || ',' ||
              coalesce(CASE WHEN value > 100 THEN CAST(user_id AS VARCHAR) END, '') AS line
       FROM events""",
)
def parent_into_child(spark: SparkSession, sf: str) -> DataFrame:
    """Quote documents: the time of the poll goes into each quote, values become a CSV line."""
    quote = F.struct(
        F.col("event_type").alias("symbol"),
        F.when(F.col("value") > 100, F.col("user_id").cast("string")).alias("LastTradePriceOnly"),
    )
    polls = (
        events(spark, sf)
        .groupBy(F.expr("event_id div 16").alias("poll"))
        .agg(F.min("ts").alias("created"), F.collect_list(quote).alias("quote"))
        .select(
            F.to_json(
                F.struct(
                    F.struct(
                        F.date_format("created", "yyyy-MM-dd HH:mm:ss").alias("created"),
                        F.struct("quote").alias("results"),
                    ).alias("query")
                )
            ).alias("doc")
        )
    )
    parsed = documents.parsed(polls, "doc", schemas.QUOTE_DOCUMENT, "d").select(
        "d.query.created", "d.query.results.quote"
    )
    rows = project.explode_with_parent(parsed, ["created"], "quote")
    return rows.select(X.csv_line("created", "symbol", "LastTradePriceOnly").alias("line"))


@CASES.query(
    "prj_try_parse",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown'
                               ELSE CAST(2015 - year(o_orderdate) AS VARCHAR) END AS age
       FROM orders""",
)
def try_parse(spark: SparkSession, sf: str) -> DataFrame:
    born = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.year("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", clean.age_or_text(born, 2015).alias("age"))


@CASES.query(
    "prj_apply_schema",
    """SELECT CAST(l_suppkey AS INTEGER) AS "squareId", CAST(l_linenumber AS VARCHAR) AS "countryCode",
              CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS sms_in
       FROM lineitem""",
)
def apply_schema(spark: SparkSession, sf: str) -> DataFrame:
    """A declared schema on text records; an empty field is null here, the country code stays text."""
    rows = clean.typed(cdr_text(spark, sf), schemas.CDR_TEXT_COUNTRY)
    return rows.select("squareId", "countryCode", F.col("smsInActivity").cast("double").alias("sms_in"))


@CASES.query(
    "prj_empty_to_zero",
    f"""SELECT "squareId", "timeInterval", "countryCode", round(sms_in, 2) AS sms_in, round(sms_out, 2) AS sms_out,
               round(call_in, 2) AS call_in, CAST(0 AS DOUBLE) AS call_out,
               round(CAST(CAST(internet AS FLOAT) AS DOUBLE), 1) AS internet
        FROM ({LINEITEM_CDR})""",
)
def empty_to_zero(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.typed(cdr_text(spark, sf), schemas.CDR, empty_as_zero=True)
    number = lambda name, digits=2: F.round(F.col(name).cast("double"), digits)
    return rows.select(
        "squareId",
        "timeInterval",
        "countryCode",
        number("smsInActivity").alias("sms_in"),
        number("smsOutActivity").alias("sms_out"),
        number("callInActivity").alias("call_in"),
        number("callOutActivity").alias("call_out"),
        number("internetTrafficActivity", 1).alias("internet"),
    )


def _phrase(*words: str) -> str:
    return " AND ".join(f"list_contains(w, '{word}')" for word in words)


@CASES.query(
    "flt_keyword_track",
    rf"""SELECT doc_id FROM (SELECT doc_id, regexp_split_to_array(lower(text), '\s+') AS w FROM documents)
        WHERE ({_phrase("pour", "avec", "sur")}) OR ({_phrase("that", "with", "this")})""",
)
def keyword_track(spark: SparkSession, sf: str) -> DataFrame:
    found = X.matches_any_phrase("text", ["pour Avec sur", "that with this"])
    return table(spark, sf, "documents").where(found).select("doc_id")


@CASES.query("prj_time_bucket", "SELECT event_id, strftime(ts, '%y-%m-%d|%H') AS bucket FROM events")
def time_bucket(spark: SparkSession, sf: str) -> DataFrame:
    millis = F.unix_millis(times.instant(F.col("ts")))
    return events(spark, sf).select("event_id", times.bucket_of_epoch_millis(millis).alias("bucket"))


@CASES.query("prj_variable_bucket", "SELECT event_id, strftime(ts, '%y-%m-%d|%H') AS bucket FROM events WHERE value >= 12.5")
def variable_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """A statement that takes its bucket format from a session variable, and its table and least value from markers."""
    variables.declare(spark, date_fmt="yy-MM-dd|HH")
    try:
        bucket = "SELECT event_id, date_format(ts, date_fmt) AS bucket FROM {rows} WHERE value >= :least"
        return variables.query(spark, bucket, {"least": 12.5}, rows=events(spark, sf))
    finally:
        variables.drop(spark, "date_fmt")  # the statement has read it


@CASES.query(
    "flt_cross_column",
    """SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem
       WHERE l_discount + l_tax >= l_quantity / 500 + l_linenumber / 100""",
)
def cross_column(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .where(
            F.col("l_discount") + F.col("l_tax") >= F.col("l_quantity") / 500 + F.col("l_linenumber") / 100
        )
        .select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    )


@CASES.query(
    "prj_concat_key",
    """SELECT event_id, CAST(user_id AS VARCHAR) || ':' || strftime(ts, '%Y-%m-%d') || ':' ||
              CASE WHEN value > 50 THEN 'good' ELSE 'bad' END AS key
       FROM events""",
)
def concat_key(spark: SparkSession, sf: str) -> DataFrame:
    rating = F.when(F.col("value") > 50, "good").otherwise("bad")
    return events(spark, sf).select(
        "event_id", X.joined_key(F.col("user_id"), F.date_format("ts", "yyyy-MM-dd"), rating).alias("key")
    )


@CASES.query(
    "flt_drop_nan",
    """SELECT l_orderkey AS stamp, l_linenumber AS activity, l_quantity AS heart_rate FROM lineitem
       WHERE l_discount <> 0 AND l_linenumber <> 1""",
)
def drop_nan(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor lines: those with a NaN anywhere go, and those with the resting label."""
    gap = F.when(F.col("l_discount") == 0, F.lit("NaN")).otherwise(F.col("l_discount").cast("string"))
    label = F.when(F.col("l_linenumber") == 1, F.lit("0")).otherwise(F.col("l_linenumber").cast("string"))
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws(" ", "l_orderkey", label, "l_quantity", gap).alias("line")
    )
    f = F.split("line", " ")
    return lines.where(~F.col("line").contains("NaN") & (f[1] != "0")).select(
        f[0].cast("long").alias("stamp"), f[1].cast("int").alias("activity"), f[2].cast("double").alias("heart_rate")
    )


#: orders with nulls: no customer where the priority is low, no price where the order is pending
def _gappy(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )


_GAPPY = """(SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS custkey,
                    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)"""


@CASES.query("na_drop", f"SELECT * FROM {_GAPPY} WHERE custkey IS NOT NULL AND price IS NOT NULL")
def na_drop(spark: SparkSession, sf: str) -> DataFrame:
    return nulls.drop_any(_gappy(spark, sf))


@CASES.query("na_fill", f"SELECT o_orderkey, coalesce(custkey, 0) AS custkey, price FROM {_GAPPY}")
def na_fill(spark: SparkSession, sf: str) -> DataFrame:
    return nulls.fill(_gappy(spark, sf), 0, ["custkey"])


@CASES.query(
    "na_replace",
    f"SELECT o_orderkey, CASE WHEN coalesce(custkey, 0) = 0 THEN 1 ELSE custkey END AS custkey, price FROM {_GAPPY}",
)
def na_replace(spark: SparkSession, sf: str) -> DataFrame:
    filled = nulls.fill(_gappy(spark, sf), 0, ["custkey"])
    return nulls.replace(filled, {0: 1}, ["custkey"])
