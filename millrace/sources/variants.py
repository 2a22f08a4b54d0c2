"""JSON of mixed shape as VARIANT columns: parsed once, its schema a combinable aggregate, its fields read by path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(df: DataFrame, col: str, name: str = "doc") -> DataFrame:
    """``col`` parsed as a variant; text that is no JSON gives null, JSON null a variant null."""
    return df.withColumn(name, F.try_parse_json(col))


def schema_of(df: DataFrame, col: str = "doc") -> str:
    """The one schema that holds all documents, from one pass with partial aggregation (fields of several types are VARIANT)."""
    return df.agg(F.schema_of_variant_agg(col)).first()[0]


def field(doc: str | Column, path: str, kind: str) -> Column:
    """A field as a type; null where it is missing or of another shape."""
    return F.try_variant_get(doc, path, kind)


def fields(df: DataFrame, paths: Mapping[str, tuple[str, str]], doc: str = "doc") -> DataFrame:
    """``df`` with a column for every ``name: (path, type)``."""
    return df.withColumns({name: field(doc, path, kind) for name, (path, kind) in paths.items()})


def type_of(doc: str | Column, path: str = "$") -> Column:
    """The type of a field: ``VOID`` for a JSON null, null where it is missing."""
    part = F.try_variant_get(doc, path, "variant")
    return F.schema_of_variant(part)


def elements(df: DataFrame, path: str, doc: str = "doc", kept: tuple[str, ...] = ()) -> DataFrame:
    """A row ``element`` (variant) for every entry of an array; documents without that array give none."""
    part = F.try_variant_get(doc, path, "array<variant>")
    return df.select(*kept, F.explode(part).alias("element"))


def keys_and_values(df: DataFrame, path: str = "$", doc: str = "doc", kept: tuple[str, ...] = ()) -> DataFrame:
    """A row ``key, value`` (variant) for every field of an object, whatever its fields are called."""
    part = F.try_variant_get(doc, path, "map<string,variant>")
    return df.select(*kept, F.explode(part).alias("key", "value"))
