"""Column expressions on numeric arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_above(values: Column, first: int, count: int, threshold: float) -> Column:
    """True where one of ``count`` elements from zero-based position ``first`` exceeds the threshold."""
    return F.exists(F.slice(values, first + 1, count), lambda x: x > threshold)


def any_column_above(cols: list[str], threshold: float) -> Column:
    """The same predicate on named columns."""
    return reduce(lambda a, b: a | b, [F.col(c) > threshold for c in cols])


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x
    )


def squared_distance(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: (a - b) * (a - b)),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
