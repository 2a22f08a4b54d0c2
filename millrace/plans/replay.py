"""Drive a streaming query over a table in arrival order.

A slice of the table lands as files, the query runs with ``availableNow`` until
it has read them, then the next slice lands. Each round is one micro-batch (plus,
for watermarked state, a closing one) and each round is a restart from the
checkpoint, so carried state is always exercised.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace import scratch

SLICES = 3


def day_bounds(df: DataFrame, ts: str, n: int) -> list[datetime]:
    """``n + 1`` midnights that cut the days of ``df`` into ``n`` ranges of whole days.

    Day ``d`` (zero-based, of ``days``) belongs to range ``d * n // days``. Without times there are no bounds.
    """
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    if lo is None:
        return []
    start = lo.replace(hour=0, minute=0, second=0, microsecond=0)
    days = (hi.replace(hour=0, minute=0, second=0, microsecond=0) - start).days + 1
    return [start + timedelta(days=-(-i * days // n)) for i in range(n + 1)]


def day_slices(df: DataFrame, ts: str, n: int = SLICES) -> list[DataFrame]:
    """The table cut along time; each slice is a range filter the scan can skip files with.

    Rows without a time come first.
    """
    return slices_between(df, ts, day_bounds(df, ts, n), n)


def slices_between(df: DataFrame, ts: str, bounds: Sequence[datetime], n: int = SLICES) -> list[DataFrame]:
    """The slices of a table along bounds that several tables may share."""
    if not bounds:
        return [df, *[df.limit(0)] * (n - 1)]
    at = lambda moment: F.lit(moment).cast("timestamp_ntz")
    first = df.where(F.col(ts).isNull() | (F.col(ts) < at(bounds[1])))
    return [first, *[df.where((F.col(ts) >= at(a)) & (F.col(ts) < at(b))) for a, b in zip(bounds[1:], bounds[2:])]]


def drain(writer: DataStreamWriter, checkpoint: str) -> list:
    """Run until everything that has landed is processed; returns the progress reports.

    The number of state partitions is the session's, and fixed with the first run of a checkpoint.
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress


def replay(
    spark: SparkSession,
    inputs: Mapping[str, Sequence[DataFrame]],
    build: Callable[..., DataStreamWriter],
    label: str,
) -> list:
    """Land slice i of every input, run ``build(**streams)`` to the end, repeat."""
    checkpoint = scratch.new_dir(spark, f"{label}-checkpoint")
    landing = {name: scratch.new_dir(spark, f"{label}-{name}") for name in inputs}
    rounds = len(next(iter(inputs.values())))
    progress = []
    for i in range(rounds):
        for name, slices in inputs.items():
            slices[i].write.mode("append").parquet(landing[name])
        streams = {
            name: spark.readStream.schema(slices[0].schema).parquet(landing[name])
            for name, slices in inputs.items()
        }
        progress += drain(build(**streams), checkpoint)
    return progress


def replay_batches(
    df: DataFrame,
    ts: str,
    each_batch: Callable[[DataFrame, int], None],
    label: str,
    n: int = SLICES,
) -> list:
    """``replay`` for per-batch functions without streaming state: batch i is slice i."""
    return replay(
        df.sparkSession,
        {"rows": day_slices(df, ts, n)},
        lambda rows: rows.writeStream.foreachBatch(each_batch),
        label,
    )
