"""Null handling on chosen columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def drop_any(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def fill(df: DataFrame, value, subset: Sequence[str]) -> DataFrame:
    return df.fillna(value, subset=list(subset))


def replace(df: DataFrame, mapping: Mapping, subset: Sequence[str]) -> DataFrame:
    return df.replace(dict(mapping), subset=list(subset))
