"""Per-batch functions for ``foreachBatch``: they may use every batch operator,
and each writes only the directory of its own batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import layout
from millrace.operators.joins import exclusive_sides
from millrace.sinks.files import BatchFn, batch_dir, per_batch


def with_previous(
    path: str,
    prepare: Callable[[DataFrame], DataFrame],
    combine: Callable[[DataFrame, DataFrame], DataFrame],
) -> BatchFn:
    """Combine each batch with the one before it; the first batch emits nothing.

    The prepared batch is kept on storage under ``path/kept``, so the previous batch
    is still there after a restart. Results go to ``path/out``.
    """

    def step(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        kept = batch_dir(f"{path}/kept", batch_id)
        prepare(df).write.mode("overwrite").parquet(kept)
        if batch_id == 0:
            return
        current = spark.read.parquet(kept)
        previous = spark.read.schema(current.schema).parquet(batch_dir(f"{path}/kept", batch_id - 1))
        per_batch(f"{path}/out")(combine(current, previous), batch_id)

    return step


def two_streams(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two streams as one, so that a micro-batch holds the new rows of both. Schemas may differ; ``on_both`` parts them again."""
    packed = [df.select(F.lit(side).alias("side"), F.struct("*").alias(name)) for side, name, df in ((1, "first", first), (2, "second", second))]
    return packed[0].unionByName(packed[1], allowMissingColumns=True)


def on_both(step: Callable[[DataFrame, DataFrame, int], None]) -> BatchFn:
    """A function of both sides of a batch of ``two_streams``: only rows of one batch meet, and either side may be empty.

    The batch is read once, however often the function uses its sides.
    """

    def run(df: DataFrame, batch_id: int) -> None:
        def split(rows: DataFrame) -> None:
            step(rows.where("side = 1").select("first.*"), rows.where("side = 2").select("second.*"), batch_id)

        layout.shared(df, [split])

    return run


def exclusive_counts(
    path: str, channel: str, first: Sequence[str], second: Sequence[str], key: str, row_id: str
) -> BatchFn:
    """Rows per batch whose key came only through ``first`` channels, or only through ``second``.

    One row per batch; summing the rows up to a batch gives the cumulative counts, and
    a batch that is run again replaces its own row.
    """

    def step(df: DataFrame, batch_id: int) -> None:
        def write(rows: DataFrame) -> None:
            sided = rows.withColumn("_first", F.col(channel).isin(*first))
            alone = exclusive_sides(sided, "_first", [key], [row_id])
            alone.agg(
                F.count_if("_first").alias("only_first"), F.count_if(~F.col("_first")).alias("only_second")
            ).write.mode("overwrite").parquet(batch_dir(path, batch_id))

        tracked = df.where(F.col(channel).isin(*first, *second)).select(row_id, channel, key)
        layout.shared(tracked, [write])

    return step
