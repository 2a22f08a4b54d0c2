"""File sinks. Every per-batch sink writes the directory of its own batch and
overwrites it, so a batch that is run again leaves the same files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BatchFn = Callable[[DataFrame, int], None]


def text(df: DataFrame, path: str, col: str = "value") -> None:
    df.select(F.col(col).cast("string")).write.text(path)


def key_value_lines(df: DataFrame, path: str, key: str, value: str) -> None:
    """``key<TAB>value`` lines."""
    df.select(key, value).write.csv(path, sep="\t")


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


def preview(df: DataFrame, n: int = 10) -> None:
    """Print the first ``n`` rows; only those rows reach the driver."""
    df.show(n, truncate=False)


def per_batch_text(prefix: str, suffix: str = "") -> BatchFn:
    """One text directory ``prefix-<batch>[.suffix]`` per batch."""

    def write(df: DataFrame, batch_id: int) -> None:
        tail = f".{suffix}" if suffix else ""
        df.write.mode("overwrite").text(f"{prefix}-{batch_id}{tail}")

    return write


def batch_dir(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def per_batch(path: str, fmt: str = "parquet") -> BatchFn:
    """One partition directory per batch of a table with column ``batch_id``."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.format(fmt).mode("overwrite").save(batch_dir(path, batch_id))

    return write


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last batch written by ``per_batch``: complete-mode results."""
    table = spark.read.parquet(path)
    last = table.select("batch_id").agg(F.max("batch_id")).scalar()
    return table.where(F.col("batch_id") == last).drop("batch_id")


def jdbc(df: DataFrame, url: str, table: str, mode: str = "error", **properties: str) -> None:
    """Write to a database table; every partition opens one connection."""
    df.write.jdbc(url, table, mode=mode, properties=properties)
