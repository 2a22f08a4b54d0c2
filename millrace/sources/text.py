"""Text lines, delimited lines, and files as streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text as X


def lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in column ``value``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a folder as a stream, files already there included."""
    return spark.readStream.text(path)


def start_marker(spark: SparkSession, checkpoint: str) -> int:
    """When the query of this checkpoint started for the first time, in microseconds by the clock of the storage.

    The first call leaves a small file beside the checkpoint's own, whose modification time is the start; later calls, after a restart too, read it.
    """
    path = f"{checkpoint}/started"
    spark.range(1).coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.parquet(path).agg(F.min(F.unix_micros("_metadata.file_modification_time"))).first()[0]


def stream_new_lines(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Lines of the files that land after the query's first start; what lay in the folder before is never read.

    Give the checkpoint the query will use. A file of the same millisecond as the start counts as there before; a file that
    was there and is written anew counts as new.
    """
    start = F.timestamp_micros(F.lit(start_marker(spark, checkpoint)))
    fresh = F.col("_metadata.file_modification_time") > start
    return spark.readStream.text(path).where(fresh).select("value")


def stream_files(
    spark: SparkSession,
    directory: str,
    fmt: str,
    schema: T.StructType | str,
    *,
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Directory as a stream, files already there included; ``glob`` selects by file name."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(directory)


def fields(line: Column, kind: str) -> Column:
    """Split a line: ``comma``, ``tab``, ``blank`` and ``whitespace`` drop trailing empty fields,
    ``tab_all`` keeps them."""
    if kind == "tab_all":
        return F.split(line, "\t")
    if kind == "blank":
        return X.tokens(line)
    if kind == "whitespace":
        return X.words(line)
    sep = {"comma": ",", "tab": "\t"}[kind]
    kept = F.rtrim(line, F.lit(sep))
    return F.when(kept == "", F.array().cast("array<string>")).otherwise(F.split(kept, sep))


def positional(lines_df: DataFrame, kind: str, names: dict[str, int], line: str = "value") -> DataFrame:
    """Name chosen positions of a delimited line, once; a missing position is null."""
    split = lines_df.select(fields(F.col(line), kind).alias("_f"))
    return split.select(*[F.get("_f", F.lit(i)).alias(n) for n, i in names.items()])


def tab_table(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Header-less tab file: types inferred in one pass over the file, columns renamed by position."""
    return spark.read.option("inferSchema", True).csv(path, sep="\t").toDF(*names)


def tab_typed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Tab file with a declared schema, so unused fields are not parsed."""
    return spark.read.schema(schema).option("emptyValue", "").csv(path, sep="\t")


def merged(readers: Iterable[Callable[[], DataFrame]]) -> DataFrame:
    """Several inputs of one shape as one DataFrame; batch or stream."""
    return reduce(DataFrame.unionByName, [read() for read in readers])


def with_file_name(df: DataFrame, name: str = "file") -> DataFrame:
    """Tag rows of a file source with the base name of their file."""
    return df.select("*", X.base_name(F.col("_metadata.file_name")).alias(name))


def integers(spark: SparkSession, first: int, last: int) -> DataFrame:
    """The integers ``first..last`` as a distributed column ``id``."""
    return spark.range(first, last + 1)
