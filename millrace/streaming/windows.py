"""Event-time windows. Every function takes a batch or a streaming DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import instant, wall


def watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Give ``ts`` the type a watermark needs, and the watermark."""
    return df.withColumn(ts, instant(F.col(ts))).withWatermark(ts, delay)


def tumbling_counts(df: DataFrame, ts: str, keys: Sequence[str], length: str) -> DataFrame:
    """Frequency of each key per window."""
    return (
        df.groupBy(F.window(ts, length).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(wall(F.col("w.start")).alias("window_start"), *keys, "n")
    )


def sliding_average(
    df: DataFrame, ts: str, keys: Sequence[str], value: str, length: str, slide: str, slides: int
) -> DataFrame:
    """Sliding sum, its share per slide (``sum / slides``, the moving average of one reading per
    slide) and the true average of the readings, which also holds for a half-filled window."""
    return (
        df.groupBy(F.window(ts, length, slide).alias("w"), *keys)
        .agg(
            F.sum(value).alias("window_sum"),
            (F.sum(value) / F.lit(slides)).alias("per_slide"),
            F.avg(value).alias("window_avg"),
        )
        .select(wall(F.col("w.start")).alias("window_start"), *keys, "window_sum", "per_slide", "window_avg")
    )


def session_counts(df: DataFrame, ts: str, keys: Sequence[str], gap: str) -> DataFrame:
    """Rows per key and session; a pause longer than ``gap`` ends a session, one of
    exactly ``gap`` does not.

    On a stream the sessions of one key are merged inside each input partition
    before the shuffle (see ``session.RUNTIME``).
    """
    return (
        df.groupBy(F.session_window(ts, gap).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, wall(F.col("w.start")).alias("session_start"), wall(F.col("w.end")).alias("session_end"), "n")
    )


def session_counts_batch(df: DataFrame, ts: str, keys: Sequence[str], gap: str, slice_unit: str = "day") -> DataFrame:
    """The same on a table, in two steps: sessions inside a time slice, so one busy key is shared
    by many tasks, then those partial sessions merged where they overlap across slices."""
    stamped = df.withColumn(ts, instant(F.col(ts)))
    micros = F.unix_micros("w.end") - F.unix_micros("w.start")
    length = F.make_interval(secs=(micros.cast("decimal(20, 6)") / 1_000_000).cast("decimal(18, 6)"))
    partial = (
        stamped.groupBy(
            F.session_window(ts, gap).alias("w"), F.date_trunc(slice_unit, ts).alias("slice"), *keys
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, F.col("w.start").alias("start"), length.alias("length"), "n")
    )
    return (
        partial.groupBy(F.session_window("start", F.col("length")).alias("w"), *keys)
        .agg(F.sum("n").alias("n"))
        .select(*keys, wall(F.col("w.start")).alias("session_start"), wall(F.col("w.end")).alias("session_end"), "n")
    )
