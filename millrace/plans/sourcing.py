"""Sources. Each query lands a table in the format under test and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas, scratch
from millrace.plans.base import Cases, events, table
from millrace.sources import archives, dictionary, documents, envelope, polls, text, variants, zip_entries
from millrace.plans.replay import drain

CASES = Cases()

#: rows of a unique key that one landed document holds at most
DOCUMENT_ROWS = 32


@CASES.query("src_text_lines", "SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def text_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "text")
    table(spark, sf, "documents").select("text").write.text(path)
    return text.lines(spark, path).select(F.col("value").alias("line"))


@CASES.query(
    "src_stream_text",
    """SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
       GROUP BY line""",
)
def stream_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    landing, out, checkpoint = (
        scratch.new_dir(spark, name) for name in ("text-in", "text-out", "text-checkpoint")
    )
    third = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3))
    for number in range(3):
        part = docs.where(third == number)
        part.select("text").write.mode("append").text(landing)
        drain(
            text.stream_lines(spark, landing).writeStream.format("parquet").option("path", out), checkpoint
        )
    return (
        spark.read.parquet(out)
        .groupBy(F.col("value").alias("line"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@CASES.query(
    "src_new_files",
    """SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents WHERE coalesce(doc_id, 0) % 3 <> 0)
       GROUP BY line""",
)
def new_files(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the texts lies in the folder before the first start; the others land after it, one before a restart."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    landing, out, checkpoint = (scratch.new_dir(spark, f"new-files-{name}") for name in ("in", "out", "checkpoint"))
    third = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3))
    for number in range(3):
        docs.where(third == number).select("text").write.mode("append").text(landing)
        lines = text.stream_new_lines(spark, landing, checkpoint)
        drain(lines.writeStream.format("parquet").option("path", out), checkpoint)
    return spark.read.parquet(out).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@CASES.query("src_stream_files", "SELECT event_id, user_id, event_type, value FROM events")
def stream_files(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("event_id", "user_id", "event_type", "value")
    landing, out, checkpoint = (
        scratch.new_dir(spark, name) for name in ("files-in", "files-out", "files-checkpoint")
    )
    rows.write.csv(landing)
    rows.write.mode("append").json(landing)  # not selected by the glob
    stream = text.stream_files(spark, landing, "csv", rows.schema, glob="*.csv", max_files=64)
    drain(stream.writeStream.format("parquet").option("path", out), checkpoint)
    return spark.read.parquet(out)


@CASES.query(
    "src_delimited",
    """SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_returnflag AS flag,
              5 AS n_all,
              CASE WHEN l_returnflag <> 'N' THEN 5 WHEN l_linestatus <> 'F' THEN 4 ELSE 3 END AS n_kept
       FROM lineitem""",
)
def delimited(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "tsv")
    status = F.when(F.col("l_linestatus") == "F", "").otherwise(F.col("l_linestatus"))
    last = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag"))
    line = F.concat_ws("\t", "l_orderkey", "l_linenumber", "l_returnflag", status, last)
    table(spark, sf, "lineitem").select(line).write.text(path)
    value = F.col("value")
    every, kept = text.fields(value, "tab_all"), text.fields(value, "tab")
    return text.lines(spark, path).select(
        every[0].cast("long").alias("order_key"),
        every[1].cast("int").alias("line_number"),
        every[2].alias("flag"),
        F.size(every).alias("n_all"),
        F.size(kept).alias("n_kept"),
    )


@CASES.query("src_json_lines", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def json_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents.parsed(events(spark, sf), "props", "k int")
    return rows.select("event_id", "doc.k")


@CASES.query(
    "src_json_infer", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders"
)
def json_infer(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "json")
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    table(spark, sf, "orders").select(*cols).write.json(path)
    return documents.infer(spark, path).select(*cols)


@CASES.query(
    "src_variant",
    """SELECT event_id,
              CASE event_type WHEN 'click' THEN 'number' WHEN 'view' THEN 'text' WHEN 'purchase' THEN 'object' WHEN 'error' THEN 'none' ELSE 'list' END AS kind,
              CASE WHEN event_type <> 'error' THEN value END AS amount, CASE WHEN event_type = 'signup' THEN 2 END AS entries
       FROM events""",
)
def variant(spark: SparkSession, sf: str) -> DataFrame:
    """One field in five shapes: a number, a text, an object, a list and none; all are read without loss."""
    path = scratch.new_dir(spark, "variants")
    shaped = (
        F.when(F.col("event_type") == "click", F.col("value").cast("string"))
        .when(F.col("event_type") == "view", F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"')))
        .when(F.col("event_type") == "purchase", F.to_json(F.struct(F.col("value").alias("amount"), F.col("user_id").alias("by"))))
        .when(F.col("event_type") == "error", F.lit("null"))
        .otherwise(F.concat(F.lit("["), F.col("value").cast("string"), F.lit(', "eur"]')))
    )
    events(spark, sf).select(F.concat(F.lit('{"id":'), "event_id", F.lit(',"v":'), shaped, F.lit("}"))).write.text(path)
    docs = variants.parsed(text.lines(spark, path), "value")
    kind = variants.type_of("doc", "$.v")
    named = (
        F.when(kind.rlike("^(DECIMAL|BIGINT|DOUBLE)"), "number").when(kind == "STRING", "text").when(kind == "VOID", "none")
        .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "list")
    )
    amounts = [variants.field("doc", at, "double") for at in ("$.v", "$.v.amount", "$.v[0]")]
    return docs.select(
        variants.field("doc", "$.id", "bigint").alias("event_id"), named.alias("kind"), F.coalesce(*amounts).alias("amount"),
        F.size(variants.field("doc", "$.v", "array<variant>")).alias("entries"),
    ).withColumn("entries", F.when(F.col("kind") == "list", F.col("entries")))


@CASES.query(
    "src_nested_json",
    """SELECT 'poll-' || CAST(o_orderkey // 32 AS VARCHAR) AS poll, CAST(o_orderkey AS INTEGER) AS id,
              o_orderpriority AS "stationName", o_orderstatus AS "statusValue" FROM orders""",
)
def nested_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "nested")
    station = F.struct(
        F.col("o_orderkey").cast("int").alias("id"),
        F.col("o_orderpriority").alias("stationName"),
        F.col("o_orderstatus").alias("statusValue"),
    )
    poll = F.concat(F.lit("poll-"), F.expr(f"o_orderkey div {DOCUMENT_ROWS}"))
    (
        table(spark, sf, "orders")
        .groupBy(poll.alias("executionTime"))
        .agg(F.collect_list(station).alias("stationBeanList"))
        .write.json(path)
    )
    schema = f"executionTime string, {schemas.STATION_DOCUMENT}"
    polls = documents.documents(spark, path, schema, per_line=True)
    rows = documents.elements(polls, "stationBeanList", F.col("executionTime").alias("poll"))
    return rows.select("poll", "id", "stationName", "statusValue")


@CASES.query(
    "src_polls",
    """SELECT 'input' || (o_orderkey % 2) AS input, 'poll-' || CAST(o_orderkey // 32 AS VARCHAR) AS poll, CAST(o_orderkey AS INTEGER) AS id,
              o_orderpriority AS "stationName", o_orderstatus AS "statusValue" FROM orders""",
)
def polled(spark: SparkSession, sf: str) -> DataFrame:
    """Two inputs of polled documents that land in three rounds, read by the source's own offsets; every round is a restart."""
    base, out, checkpoint = (scratch.new_dir(spark, f"polls-{name}") for name in ("in", "out", "checkpoint"))
    side, poll = F.pmod("o_orderkey", F.lit(2)), F.concat(F.lit("poll-"), F.expr(f"o_orderkey div {DOCUMENT_ROWS}"))
    station = F.struct(
        F.col("o_orderkey").cast("int").alias("id"), F.col("o_orderpriority").alias("stationName"), F.col("o_orderstatus").alias("statusValue")
    )
    answers = table(spark, sf, "orders").groupBy(side.alias("side"), poll.alias("executionTime")).agg(F.collect_list(station).alias("stationBeanList"))
    answers = answers.select("side", F.pmod(F.xxhash64("executionTime"), F.lit(3)).alias("round"), F.to_json(F.struct("executionTime", "stationBeanList")).alias("line"))
    folders = [f"{base}/input{n}" for n in range(2)]
    schema = f"executionTime string, {schemas.STATION_DOCUMENT}"
    for number in range(3):
        for n, folder in enumerate(folders):
            # a round's answers lie under names of its own, which sort after those of the rounds before
            staged = scratch.new_dir(spark, "polls-staged")
            answers.where((F.col("side") == n) & (F.col("round") == number)).select("line").write.text(staged)
            polls.land(spark, staged, folder, f"{number:04d}")
        rows = polls.stream(spark, folders).select("input", F.explode(F.split("document", "\n")).alias("line")).where("line <> ''")
        drain(rows.writeStream.format("parquet").option("path", out), checkpoint)
    parsed = documents.parsed(spark.read.parquet(out), "line", schema).select("input", "doc.*")
    rows = documents.elements(parsed, "stationBeanList", F.col("input"), F.col("executionTime").alias("poll"))
    return rows.select("input", "poll", "id", "stationName", "statusValue")


@CASES.query("src_csv_infer", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def csv_infer(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "csv")
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]
    table(spark, sf, "lineitem").select(*names).write.csv(path, sep="\t")
    inferred = text.tab_table(spark, path, names)
    return inferred.withColumn("l_orderkey", F.col("l_orderkey").cast("long"))


@CASES.query("src_table", "SELECT o_orderkey, o_orderstatus FROM orders")
def saved_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.option("path", path).saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return rows


@CASES.query("src_multi_union", "SELECT event_id, user_id, event_type FROM events")
def multi_union(spark: SparkSession, sf: str) -> DataFrame:
    path, inputs = scratch.new_dir(spark, "inputs"), 4
    rows = events(spark, sf).select("event_id", "user_id", "event_type")
    rows.withColumn("input", F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(inputs))).write.partitionBy("input").parquet(path)
    return text.merged(
        [
            lambda i=i: spark.read.schema(rows.schema).parquet(f"{path}/input={i}")
            for i in range(inputs)
        ]
    )


@CASES.query("src_envelope", "SELECT event_id, event_type, value FROM events")
def message_envelope(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_dir(spark, "messages")
    body = F.to_json(F.struct("event_id", "event_type", "value"))
    events(spark, sf).select(
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"), F.encode(body, "UTF-8").alias("value")
    ).write.parquet(path)
    messages = envelope.payload(spark.read.parquet(path))
    schema = "event_id long, event_type string, value double"
    return documents.parsed(messages, "value", schema).select("doc.*")


@CASES.query(
    "src_dictionary",
    """SELECT DISTINCT w AS word, reverse(w) AS translation
       FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)""",
)
def word_list(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.dictionary(spark, landed_dictionary(spark, sf), "German")


def landed_dictionary(spark: SparkSession, sf: str) -> str:
    """Word list over the part names: comment lines, outdated entries, then the valid ones."""
    path = scratch.new_dir(spark, "dictionary")
    words = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    entry = F.explode(
        F.array(
            F.struct(F.lit(0).alias("seq"), F.concat(F.lit("# "), "word").alias("line")),
            F.struct(F.lit(1).alias("seq"), F.concat(F.lit(" "), "word", F.lit(" \told ")).alias("line")),
            F.struct(F.lit(2).alias("seq"), F.concat_ws("\t", "word", F.reverse("word")).alias("line")),
        )
    )
    words.select(entry.alias("e")).select("e.*").orderBy("seq", "line").select("line").write.text(
        f"{path}/German"
    )
    return path


@CASES.query(
    "src_range",
    """SELECT i AS id FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS i FROM orders)
       WHERE i NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def key_range(spark: SparkSession, sf: str) -> DataFrame:
    """Order numbers without line items, by the full range of numbers."""
    lo, hi = table(spark, sf, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    used = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    return text.integers(spark, lo, hi).join(used, "id", "left_anti")


@CASES.query(
    "src_archives",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority <> '5-LOW'",
)
def archive_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One file type per priority; the fifth type is unknown and must be ignored."""
    path, packed = scratch.new_dir(spark, "archives"), scratch.new_dir(spark, "zips")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")

    def rows(priority: str) -> DataFrame:
        return orders.where(F.col("o_orderpriority") == priority).drop("o_orderpriority")

    archives.zipped(rows("1-URGENT").select(F.concat_ws(",", "o_orderkey", "o_custkey").alias("value"))).write.parquet(packed)
    rows("2-HIGH").write.csv(path, header=True, compression="gzip")
    rows("3-MEDIUM").write.mode("append").option("extension", "dat").csv(path)
    rows("4-NOT SPECIFIED").write.mode("append").json(path)
    rows("5-LOW").write.mode("append").csv(path)

    found = archives.lines(spark, path).unionByName(archives.unzipped(spark.read.parquet(packed)))
    record = F.from_json("value", "o_orderkey long, o_custkey long")
    pair = F.split("value", ",")
    is_json = F.col("file").endswith(".json")
    return found.select(
        *[
            F.when(is_json, record[name]).otherwise(F.get(pair, F.lit(i)).try_cast("long")).alias(name)
            for i, name in enumerate(["o_orderkey", "o_custkey"])
        ]
    )


@CASES.query(
    "src_zip_entries",
    """SELECT 'archive' || (o_custkey % 3) || '.zip' AS file, 'part' || (o_orderkey % 17) || '.csv' AS entry, o_orderkey, o_custkey FROM orders""",
)
def zip_entry_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Three archives of 17 entries, each entry read from its own place."""
    path = scratch.new_dir(spark, "zip-entries")
    named = table(spark, sf, "orders").select(
        F.concat(F.lit("archive"), F.pmod("o_custkey", F.lit(3))).alias("archive"), F.concat(F.lit("part"), F.pmod("o_orderkey", F.lit(17))).alias("entry"),
        F.concat_ws(",", "o_orderkey", "o_custkey").alias("value"),
    )
    zip_entries.pack(named, path, "archive", "entry").count()
    found = zip_entries.lines(zip_entries.entries(spark, path), task_bytes=8 << 10)
    pair = F.split("value", ",")
    return found.select("file", "entry", *[F.get(pair, F.lit(i)).cast("long").alias(n) for i, n in enumerate(("o_orderkey", "o_custkey"))])


@CASES.query(
    "src_geojson",
    """SELECT s_suppkey AS id, x * 1.0 AS x1, y * 1.0 AS y1, x + 0.5 AS x2, y * 1.0 AS y2,
              x + 0.5 AS x3, y + 0.5 AS y3, x * 1.0 AS x4, y + 0.5 AS y4
       FROM (SELECT s_suppkey, CAST(s_suppkey % 10 AS DOUBLE) AS x, CAST(s_suppkey // 10 AS DOUBLE) AS y FROM supplier)""",
)
def geojson(spark: SparkSession, sf: str) -> DataFrame:
    return documents.grid(spark, landed_grid(spark, sf), per_line=True)


def landed_grid(spark: SparkSession, sf: str) -> str:
    """A unit grid with one square per supplier, in feature collections of bounded size."""
    path = scratch.new_dir(spark, "grid")
    x, y = F.col("x"), F.col("y")
    corners = [(x, y), (x + 0.5, y), (x + 0.5, y + 0.5), (x, y + 0.5), (x, y)]
    ring = F.array(*[F.array(a, b) for a, b in corners])
    feature = F.struct(F.col("s_suppkey").alias("id"), F.struct(F.array(ring).alias("coordinates")).alias("geometry"))
    (
        table(spark, sf, "supplier")
        .withColumn("x", F.expr("cast(s_suppkey % 10 as double)"))
        .withColumn("y", F.expr("cast(s_suppkey div 10 as double)"))
        .groupBy(F.expr(f"s_suppkey div {DOCUMENT_ROWS}").alias("tile"))
        .agg(F.collect_list(feature).alias("features"))
        .select("features")
        .write.json(path)
    )
    return path


@CASES.query(
    "src_json_map", "SELECT p_name AS key, CAST(p_partkey AS VARCHAR) AS value FROM part"
)
def json_map(spark: SparkSession, sf: str) -> DataFrame:
    """Part key → name objects, inverted to name → key."""
    path = scratch.new_dir(spark, "objects")
    entry = F.struct(F.col("p_partkey").cast("string"), "p_name")
    (
        table(spark, sf, "part")
        .groupBy(F.expr(f"p_partkey div {DOCUMENT_ROWS}").alias("chunk"))
        .agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("object"))
        .select("object")
        .write.text(path)
    )
    return documents.json_map(text.lines(spark, path), "value", swap=True)


@CASES.query("src_file_name", "SELECT event_id, 'kind=' || event_type || '.' AS file FROM events")
def file_name(spark: SparkSession, sf: str) -> DataFrame:
    """Every type of event lies in files of one name; lines do not say which, so only the tag can."""
    path = scratch.new_dir(spark, "named")
    staged = scratch.new_dir(spark, "named-staged")
    rows = events(spark, sf).select(F.col("event_id").cast("string").alias("value"), F.col("event_type").alias("kind"))
    rows.write.partitionBy("kind").text(staged)
    for kind in [r["kind"] for r in rows.select("kind").distinct().collect()]:  # a handful of types
        polls.land(spark, f"{staged}/kind={kind}", path, f"kind={kind}.")
    tagged = text.with_file_name(text.lines(spark, path))
    return tagged.select(F.col("value").cast("long").alias("event_id"), F.regexp_extract("file", r"^[^.]*\.", 0).alias("file"))
