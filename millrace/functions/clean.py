"""Column expressions that type and repair raw fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def zero_if_empty(col: Column) -> Column:
    return F.when(col == "", F.lit("0")).otherwise(col)


def typed(df: DataFrame, schema: T.StructType, empty_as_zero: bool = False) -> DataFrame:
    """Cast text columns to ``schema``. With ``empty_as_zero`` an empty field counts as "0";
    without it an unreadable field becomes null (a record is never lost to a bad cast)."""
    fields = []
    for field in schema.fields:
        raw = F.col(field.name)
        value = (
            zero_if_empty(raw).cast(field.dataType)
            if empty_as_zero
            else raw.try_cast(field.dataType)
        )
        fields.append(value.alias(field.name))
    return df.select(*fields)


def age_or_text(birth_year: Column, as_of_year: int) -> Column:
    """Year of birth → age in ``as_of_year``; text that is no year is passed through."""
    age = F.lit(as_of_year) - birth_year.try_cast("int")
    return F.coalesce(age.cast("string"), birth_year)


def any_nan(*cols: str) -> Column:
    return reduce(lambda a, b: a | b, [F.isnan(c) for c in cols])
