"""Ordering and top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_value_desc(df: DataFrame, value: str, key: Sequence[str]) -> DataFrame:
    """Largest value first, ties by key: a range-partitioned sort, never one partition."""
    return df.select(value, *key).orderBy(F.desc(value), *key)


def top_n(df: DataFrame, n: int, desc: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """The ``n`` largest rows; each partition keeps only its own ``n`` candidates."""
    return df.orderBy(*[F.desc(c) for c in desc], *ties).limit(n)
