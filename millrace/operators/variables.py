"""SQL with values put in from outside: session variables, and named markers of one statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _name(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def declare(spark: SparkSession, kind: str = "STRING", **values: object) -> None:
    """Session variables of one SQL type, made or set anew. Values travel as parameters, never as text of the statement."""
    for name, value in values.items():
        spark.sql(f"DECLARE OR REPLACE VARIABLE {_name(name)} {kind} DEFAULT NULL")
        spark.sql(f"SET VAR {_name(name)} = :value", args={"value": value})


def variable(name: str) -> Column:
    return F.expr(f"system.session.{_name(name)}")


def drop(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {_name(name)}")


def query(spark: SparkSession, statement: str, args: dict[str, object] | None = None, **tables: DataFrame) -> DataFrame:
    """A statement with named markers (``:x``) for values and ``{name}`` for tables; neither is pasted into the text as it is."""
    return spark.sql(statement, args=args or {}, **tables)
