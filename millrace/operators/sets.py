"""Set operations. The distinct forms are one aggregate over both sides: copies of
a row collapse where they are read, and one exchange serves both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def _sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row of either side with the sides it occurs on. Nulls are equal here."""
    tagged = left.withColumn("_left", F.lit(True)).unionByName(
        right.select(*left.columns).withColumn("_left", F.lit(False))
    )
    return tagged.groupBy(*left.columns).agg(
        F.bool_or("_left").alias("_in_left"), F.bool_or(~F.col("_left")).alias("_in_right")
    )


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    return _sides(left, right).where("_in_left AND _in_right").select(*left.columns)


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct left rows that do not occur on the right."""
    return _sides(left, right).where("_in_left AND NOT _in_right").select(*left.columns)


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of one side only, with ``side`` (``first`` or ``second``): both directions from one aggregate."""
    side = F.when(F.col("_in_left"), F.lit("first")).otherwise(F.lit("second")).alias("side")
    return _sides(left, right).where("_in_left <> _in_right").select(*left.columns, side)
