"""User functions: lookups registered for SQL, combinable aggregates, external commands."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_lookup(
    spark: SparkSession, name: str, first: DataFrame, second: DataFrame, default: str = "NotFound"
) -> None:
    """Register SQL function ``name(code)``: code → first → second, else ``default``.

    ``first`` has columns ``(code, via)`` and ``second`` ``(via, name)``, whatever they are called; a code occurs
    once. The function captures the tables themselves, not their rows: a call is planned as a join with them,
    broadcast or shuffled as their size asks.
    """
    view = f"lookup_{uuid.uuid4().hex}"
    code, via = first.columns
    resolved = first.toDF("code", "via").join(second.toDF("via", "name"), "via").select("code", "name")
    resolved.createOrReplaceTempView(view)
    kind = first.schema[code].dataType.simpleString()
    quoted = default.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted {kind}) RETURNS STRING "
        f"RETURN coalesce((SELECT max(name) FROM {view} WHERE code = wanted), '{quoted}')"
    )


_PARTIAL = "key string, low long, high long, over long"


def running_stats_udaf(df: DataFrame, key: str, volume: str, price: str, limit: float) -> DataFrame:
    """(least volume, greatest volume, rows with price above limit) by a user-written aggregate:
    partials per Arrow batch first, then a merge of the partials.

    ``streaming.state.stats_by_key`` is the built-in form.
    """

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            over = batch.assign(over=(batch["price"] > limit).astype("int64"))
            yield over.groupby("key", as_index=False, dropna=False).agg(
                low=("volume", "min"), high=("volume", "max"), over=("over", "sum")
            )

    rows = df.select(
        F.col(key).alias("key"), F.col(volume).alias("volume"), F.col(price).alias("price")
    )
    return (
        rows.mapInPandas(partials, _PARTIAL)
        .groupBy("key")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("over").alias("over"))
    )


def pipe_lines(df: DataFrame, col: str, command: str) -> DataFrame:
    """Send a column of single lines through an external command, one process per partition."""
    view = f"pipe_{uuid.uuid4().hex}"
    df.select(F.col(col).alias("line")).createOrReplaceTempView(view)
    quoted = command.replace("\\", "\\\\").replace("'", "\\'")
    try:
        return df.sparkSession.sql(
            f"SELECT TRANSFORM(line) USING '{quoted}' AS (line string) FROM {view}"
        )
    finally:
        df.sparkSession.catalog.dropTempView(view)
