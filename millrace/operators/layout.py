"""Physical layout: partition counts, partitioning by key, sharing a result."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel


def spread(df: DataFrame, partitions: int, keys: Sequence[str] = ()) -> DataFrame:
    """Hash-partition by ``keys``, or round-robin without keys."""
    return df.repartition(partitions, *keys)


def shrink(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer output files without a shuffle. Never used before a sort."""
    return df.coalesce(partitions)


def shared(df: DataFrame, consumers: Iterable[Callable[[DataFrame], None]]) -> None:
    """Compute ``df`` once for several consumers; blocks spill to disk and are released."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for consume in consumers:
            consume(kept)
    finally:
        kept.unpersist()
