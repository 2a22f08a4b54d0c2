"""Projections and per-record transformations on whole DataFrames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators.skew import salted_join


def translate(lines: DataFrame, id_col: str, text_col: str, dictionary: DataFrame) -> DataFrame:
    """Replace each word by its dictionary entry; unknown words and word order stay, a null text stays null.

    ``dictionary`` has one row ``(word, translation)`` per word. The words are joined with it (a few words make up
    much of any text, so hot ones are salted where Spark will not broadcast it) and put together again by row, so
    rows that share an id stay apart.
    """
    placed = lines.select(F.monotonically_increasing_id().alias("_row"), id_col, text_col)
    split = placed.select("_row", id_col, F.posexplode_outer(text.words(text_col)).alias("pos", "word"))
    found = salted_join(split, dictionary, ["word"], "left", spread_by=["_row", "pos"])
    word = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("translation", "word").alias("out")))
    return (
        found.groupBy("_row", id_col)
        .agg(F.count("pos").alias("n"), F.collect_list(word).alias("words"))
        .select(
            id_col,
            F.when(F.col("n") > 0, F.array_join(F.transform(F.array_sort("words"), lambda w: w["out"]), " ")).alias("translated"),
        )
    )


def _days(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        stamp = pd.to_datetime(batch["epoch_seconds"], unit="s", utc=True)
        yield pd.DataFrame({"id": batch["id"], "day": stamp.dt.strftime("%Y-%m-%d")})


def key_by_day_in_batches(df: DataFrame, id_col: str, seconds_col: str) -> DataFrame:
    """Key records by day with one Python call per Arrow batch (the partition-function surface).

    ``functions.times.day_of_epoch_seconds`` gives the same answer inside the JVM.
    """
    pairs = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(seconds_col).cast("long").alias("epoch_seconds")
    )
    return pairs.mapInPandas(_days, "id long, day string")


def explode_with_parent(df: DataFrame, parent: Sequence[str], children: str) -> DataFrame:
    """One row per array element, with the parent's columns carried into it."""
    return df.select(*parent, F.explode(children).alias("child")).select(*parent, "child.*")
