"""Joins. Nothing is broadcast by hint unless its size was checked; Spark's own
threshold and AQE decide for the rest, and hot keys are salted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import chunk_of, salted_join


def inner(left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Many-to-one inner join: many left rows per key, ``right`` holds a key once."""
    return salted_join(left, right, keys, "inner", spread_by=spread_by)


def exclusive(left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Left rows, duplicates included, whose key does not occur on the right.

    Not ``subtract`` (which also removes duplicates) and not ``exceptAll`` (which
    removes one for one).
    """
    return salted_join(
        left, right.select(*keys).distinct(), keys, "left_anti", spread_by=spread_by
    )


def exclusive_sides(rows: DataFrame, side: str, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Rows, duplicates included, whose key occurs with one value of ``side`` only: ``exclusive`` in every direction
    from one aggregate and one join. A null key is like no other and stays."""
    shared = rows.groupBy(*keys).agg(F.min(side).alias("_a"), F.max(side).alias("_b")).where("_a <> _b")
    return salted_join(rows, shared.select(*keys), keys, "left_anti", spread_by=spread_by)


def left_outer_default(
    left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: dict[str, object]
) -> DataFrame:
    """Left outer join that replaces missing values by defaults. Both sides hold a key once."""
    return left.join(right, list(keys), "left").fillna(defaults)


def cogroup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    row_id: str,
    chunk_rows: int = 4096,
) -> DataFrame:
    """Both value lists of every key, whichever side it occurs on.

    A group is returned in chunks of about ``chunk_rows`` values, so a key that
    holds a third of the input becomes many rows of bounded size; the union of a
    key's chunks is its complete cogroup. Lists are sorted.
    """
    tagged = left.select(key, row_id, F.col(value).alias("v"), F.lit(True).alias("from_left")).unionByName(
        right.select(key, row_id, F.col(value).alias("v"), F.lit(False).alias("from_left"))
    )
    sizes = tagged.groupBy(key).agg(F.count(F.lit(1)).alias("group_rows"))
    placed = salted_join(tagged, sizes, [key], "inner", spread_by=[row_id, "from_left"])
    chunk = chunk_of(F.col(row_id), F.col("group_rows"), chunk_rows)
    return (
        placed.withColumn("chunk", chunk)
        .groupBy(key, "chunk")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("from_left"), F.col("v")))).alias("left_values"),
            F.array_sort(F.collect_list(F.when(~F.col("from_left"), F.col("v")))).alias("right_values"),
        )
    )


def lookup_chain(
    facts: DataFrame,
    first: DataFrame,
    second: DataFrame,
    code: str,
    via: str,
    name: str,
    spread_by: Sequence[str],
    default: str = "NotFound",
) -> DataFrame:
    """code → ``via`` (table one) → ``name`` (table two), ``default`` where either step misses.

    The two small tables are chained first, so the facts are joined once.
    """
    chained = first.join(second, via, "left").select(code, name)
    joined = salted_join(facts, chained, [code], "left", spread_by=spread_by)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
