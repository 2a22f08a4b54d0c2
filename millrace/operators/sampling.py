"""Sampling and splitting. The hashed forms depend on the row alone: the same
rows are chosen in batch, on a stream and after a retry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKETS = 1_000_000


def bernoulli(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def with_replacement(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def _bucket(row_id: Sequence[str]) -> Column:
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in row_id])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % _BUCKETS


def hashed(df: DataFrame, row_id: Sequence[str], fraction: float) -> DataFrame:
    return df.where(_bucket(row_id) < int(fraction * _BUCKETS))


def random_split(df: DataFrame, test_fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(test, train); both parts together are the input."""
    test, train = df.randomSplit([test_fraction, 1 - test_fraction], seed)
    return test, train


def label_split(df: DataFrame, row_id: str, test_parts: int, parts: int) -> DataFrame:
    """Every row with a ``part``: "test" for ``test_parts`` of ``parts`` residues of the row id,
    else "train". Rows equal in value but different in id are kept apart."""
    return df.withColumn(
        "part",
        F.when(F.pmod(F.col(row_id), F.lit(parts)) < test_parts, "test").otherwise("train"),
    )
