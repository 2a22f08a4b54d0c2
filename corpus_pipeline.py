"""A training corpus from documents: quality, near copies, benchmark leaks, source mix, token shards.

Every stage takes ``(spark, docs, sf_dir)`` and decides about all documents it is given. Decisions name documents by id, so a row
with a null id stays in the first three stages; rows that share an id go together. An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import mixing, near, quality, templates, training_order
from millrace.plans.base import table
from millrace.scratch import new_dir
from millrace.session import tune


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    named = dropped.select(F.col("doc_id").alias("_dropped_id")).filter("_dropped_id IS NOT NULL").distinct()
    return docs.join(named, docs["doc_id"] == named["_dropped_id"], "left_anti")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return _without(docs, quality.classify(docs, table(spark, sf_dir, "labels")).filter("predicted = 0"))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of every group of near copies."""
    return _without(docs, near.near_duplicates(docs).filter("NOT kept"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return _without(docs, templates.contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most three times; a part of a document counts from one half on."""
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    counts = mixing.mix(docs).filter("size > 0").groupBy("doc_id").agg(F.max(times).alias("_times"))
    counts = counts.filter("_times > 0").withColumnRenamed("doc_id", "_mixed_id")
    joined = docs.join(counts, docs["doc_id"].eqNullSafe(counts["_mixed_id"]))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*[docs[c] for c in docs.columns])


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The records of the token shards, in training order."""
    path = training_order.new_path(spark)
    training_order.materialise(docs, path)
    records = training_order.read(spark, path)
    return records.select("slot", "seq", "shard", "offset", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))


STAGES = [
    ("quality", good_quality),
    ("near_dedup", near_deduplicated),
    ("decontamination", decontaminated),
    ("mix", mixed),
    ("tokens", token_shards),
]

#: The classifier and the tokenizer are beyond SQL. Tests compare the quality and mix stages with their operators, and look for planted near copies, leaks
#: and tokens by id; the operators have brute-force tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each written and read again."""
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
