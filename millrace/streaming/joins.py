"""Joins with streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import salted_join
from millrace.sinks.files import BatchFn


def within(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str, right_ts: str, span: str
) -> DataFrame:
    """Stream-stream inner join: rows of equal key whose right side follows within ``span``.

    Both sides must be watermarked; the time range lets Spark forget buffered rows.
    """
    follows = (F.col(right_ts) >= F.col(left_ts)) & (
        F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {span}")
    )
    return left.join(right, (F.col(left_key) == F.col(right_key)) & follows, "inner")


def per_window(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, length: str) -> DataFrame:
    """Stream-stream inner join of rows that fall in the same time bucket and share ``keys``.

    ``right`` holds a key once per bucket (column ``bucket``), so the result has at most
    one row per left row.
    """
    return left.withColumn("bucket", F.window(ts, length)).join(right, [*keys, "bucket"], "inner")


def enrich(table: DataFrame, keys: Sequence[str], spread_by: Sequence[str], write: BatchFn) -> BatchFn:
    """Per-batch form of stream ⋈ static: the table is broadcast while Spark's own estimate allows it, judged anew for
    every batch; beyond that batch and table are shuffled, with the batch's hot keys spread out."""

    def step(df: DataFrame, batch_id: int) -> None:
        write(salted_join(df, table, keys, spread_by=spread_by), batch_id)

    return step
