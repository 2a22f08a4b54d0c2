"""Word lists: tab-separated, ``#`` comments, ISO-8859-1, the last entry of a word wins."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dictionary(spark: SparkSession, directory: str, language: str) -> DataFrame:
    """(word, translation) of ``directory/language``.

    "Last" follows file name, position of the split in its file, then line order in
    the split, so it does not depend on how the files were divided into tasks. A language without a list is a ``ValueError``.
    """
    reader = (
        spark.read.schema("word string, translation string")
        .option("comment", "#")
        .option("encoding", "ISO-8859-1")
        .option("quote", "")
    )
    try:
        raw = reader.csv(f"{directory}/{language}", sep="\t")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"unknown language {language!r}: no word list under {directory}") from error
        raise
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    entries = raw.select(F.trim("word").alias("word"), F.trim("translation").alias("translation"), place.alias("place"))
    return (
        entries.where("word is not null and translation is not null")
        .groupBy("word")
        .agg(F.max_by("translation", "place").alias("translation"))
    )
