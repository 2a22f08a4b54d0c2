"""Grouped and global aggregation. All of these combine inside the input
partitions first, so a hot key costs one partial row per partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by_value(df: DataFrame) -> DataFrame:
    """Frequency of each distinct record."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


def reduce_by_key(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def average_by_key(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Average through the (sum, count) pair; true division."""
    return df.groupBy(*keys).agg((F.sum(value) / F.count(value)).alias(name))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The record with the least ``order`` per key: a combinable minimum, not a ranked window.

    A null in ``order`` comes last; ties are settled by the other columns.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    least = F.min(_nulls_last(order, rest)).alias("r")
    return df.groupBy(*keys).agg(least).select(*keys, *[F.col(f"r.{c}").alias(c) for c in [*order, *rest]])


def _nulls_last(order: Sequence[str], rest: Sequence[str]) -> Column:
    flags = [x for c in order for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    return F.struct(*flags, *rest)


def first_per_partition(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The record with the least ``order`` in every physical partition; an empty one gives no row."""
    rest = [c for c in df.columns if c not in order]
    return (
        df.groupBy(F.spark_partition_id().alias("partition"))
        .agg(F.min(_nulls_last(order, rest)).alias("r"))
        .select("partition", *[F.col(f"r.{c}").alias(c) for c in [*order, *rest]])
    )


def rollup_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.rollup(first, second).agg(F.count(F.lit(1)).alias("n"))


def cube_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.cube(first, second).agg(F.count(F.lit(1)).alias("n"))


def basket(df: DataFrame, key: str, item: str) -> DataFrame:
    """Distinct items of a key, sorted and blank-joined. Duplicates go before anything is
    collected, so a basket is never longer than the item vocabulary."""
    distinct = df.select(key, item).distinct()
    return distinct.groupBy(key).agg(
        F.array_join(F.array_sort(F.collect_set(item)), " ").alias("basket")
    )


def frequent_items(df: DataFrame, col: str, support: float) -> DataFrame:
    """Exact values occurring in at least ``support`` of the rows (the sketch is
    ``df.stat.freqItems``, which may add false positives)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.where(F.col("n") >= F.lit(support) * total)


def crosstab(df: DataFrame, row: str, col: str) -> DataFrame:
    """Contingency table, long: one row ``(row, col, n)`` per cell that occurs."""
    return df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def crosstab_wide(df: DataFrame, row: str, col: str, values: Sequence[object]) -> DataFrame:
    """Contingency table with one column for each of the ``values`` of ``col`` that the caller names; others are not counted."""
    # pivot the counts, not the rows: at most one row per cell is left to move
    return crosstab(df, row, col).groupBy(row).pivot(col, list(values)).sum("n").fillna(0)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, minimum and maximum of each column, one row per column.

    One aggregate over the table; the unpivot then works on its single row.
    """
    stats = {
        "count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    packed = [
        F.struct(
            F.lit(c).alias("column"),
            *[fn(c).cast("double").alias(name) for name, fn in stats.items()],
        )
        for c in cols
    ]
    return df.agg(F.array(*packed).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
