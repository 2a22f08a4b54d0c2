"""JSON: records per line, inferred schemas, nested documents, maps and GeoJSON grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas


def parsed(df: DataFrame, col: str, schema: T.StructType | str, name: str = "doc") -> DataFrame:
    """Parse a JSON column once; a malformed record gives a struct of nulls."""
    return df.withColumn(name, F.from_json(col, schema))


def infer(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with a schema read from the data (batch only)."""
    return spark.read.json(path)


def documents(spark: SparkSession, path: str, schema: T.StructType | str, per_line: bool = False) -> DataFrame:
    """JSON documents parsed with a declared schema: one per file over many lines, or one per line."""
    return spark.read.schema(schema).option("multiLine", not per_line).json(path)


def elements(df: DataFrame, array: str, *parents: Column) -> DataFrame:
    """One row per element of a nested array, parents carried along."""
    return df.select(*parents, F.explode(F.col(array)).alias("e")).select(
        *[c for c in df.select(*parents).columns], "e.*"
    )


def json_map(df: DataFrame, col: str, swap: bool = False) -> DataFrame:
    """A flat JSON object as rows (key, value); swapped on request."""
    rows = df.select(F.explode(F.from_json(col, "map<string,string>")).alias("key", "value"))
    return rows.select(F.col("value").alias("key"), F.col("key").alias("value")) if swap else rows


def grid(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """GeoJSON feature collections → (id, x1, y1, .., x4, y4): the first four vertices of the ring.

    Any number of documents may lie under ``path``; each is one task's input.
    """
    feature = F.explode("features").alias("f")
    ring = F.flatten(F.col("f.geometry.coordinates")).alias("ring")
    points = documents(spark, path, schemas.GRID_DOCUMENT, per_line).select(feature).select("f.id", ring)
    return points.select(
        "id",
        *[
            F.col("ring")[v][axis].alias(f"{label}{v + 1}")
            for v in range(4)
            for axis, label in enumerate("xy")
        ],
    )
