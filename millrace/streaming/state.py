"""Running per-key and global state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sinks.files import BatchFn, batch_dir


def running_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count per key since the start. In complete mode every key is emitted again each batch; in
    update mode only the keys that changed, which is the form for large key sets."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def read_back(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """The state that a query has stored, as a table of its key and value columns: that of its last batch, or of ``batch_id``.

    The stream emits nothing for it, so an update-mode query with a large state can be read whole when it is wanted.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*", "value.*")


def stats_by_key(df: DataFrame, keys: Sequence[str], volume: str, price: str, limit: float) -> DataFrame:
    """Running least and greatest volume and number of rows with a price above ``limit``.

    A key without rows in a batch keeps its state, and its first row counts.
    """
    return df.groupBy(*keys).agg(
        F.min(volume).alias("low"),
        F.max(volume).alias("high"),
        F.count_if(F.col(price) > limit).alias("over"),
    )


def threshold_alarm(path: str, volume: str, price: str, limit: float, reset_above: int) -> BatchFn:
    """Global running minimum, maximum and threshold counter; the counter raises an alarm and
    starts again once it exceeds ``reset_above``.

    The state is one row per batch in ``path``; a batch reads its predecessor's row,
    so a repeated batch gives the same row. Every record is looked at.
    """

    def step(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        now = df.agg(
            F.min(volume).alias("low"),
            F.max(volume).alias("high"),
            F.count_if(F.col(price) > limit).alias("over"),
        )
        if batch_id > 0:
            before = spark.read.parquet(batch_dir(path, batch_id - 1)).select(
                "low", "high", F.col("carried").alias("over")
            )
            now = now.unionByName(before).agg(
                F.min("low").alias("low"), F.max("high").alias("high"), F.sum("over").alias("over")
            )
        alarm = F.col("over") > reset_above
        now.select(
            "low",
            "high",
            F.col("over").alias("reached"),
            alarm.alias("alarm"),
            F.when(alarm, F.lit(0)).otherwise(F.col("over")).cast("long").alias("carried"),
        ).write.mode("overwrite").parquet(batch_dir(path, batch_id))

    return step
