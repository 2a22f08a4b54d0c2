"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.sinks.files import BatchFn


def create(df: DataFrame, name: str, path: str | None = None) -> None:
    """Save as a new table; an existing one is an error, never overwritten."""
    writer = df.write.mode("error")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def per_batch(prefix: str, path: str | None = None) -> BatchFn:
    """One table per batch, ``<prefix>_<batch>``. A batch that is run again replaces its own table."""

    def write(df: DataFrame, batch_id: int) -> None:
        writer = df.write.mode("overwrite")
        if path:
            writer = writer.option("path", f"{path}/{prefix}_{batch_id}")
        writer.saveAsTable(f"{prefix}_{batch_id}")

    return write
