"""Query registry and the column stand-ins shared by the queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import instant
from millrace.session import tune

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    run: Query
    sql: str | None


class Cases(dict):
    """``@CASES.query("key", sql)`` registers a query under its key."""

    def query(self, key: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return fn(tune(spark), sf_dir)

            if key in self:
                raise ValueError(f"query {key!r} is defined twice")
            self[key] = Case(run, sql)
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k_of_props(props: str = "props") -> Column:
    return F.from_json(props, "k int")["k"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stock quotes."""
    return events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.col("event_type").alias("symbol"),
        (F.col("value") * 10).alias("price"),
        k_of_props().cast("long").alias("volume"),
    )


def cdr_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw call records: all text, some fields empty."""
    blank_if = lambda flag, value: F.when(F.col("l_returnflag") == flag, F.lit("")).otherwise(
        F.col(value).cast("string")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("squareId"),
        F.unix_millis(instant(F.col("l_shipdate"))).cast("string").alias("timeInterval"),
        F.col("l_linenumber").cast("string").alias("countryCode"),
        blank_if("R", "l_quantity").alias("smsInActivity"),
        blank_if("N", "l_discount").alias("smsOutActivity"),
        F.col("l_tax").cast("string").alias("callInActivity"),
        F.lit("").alias("callOutActivity"),
        F.col("l_extendedprice").cast("string").alias("internetTrafficActivity"),
    )


#: SQL text of the day-range number of an event when the days are cut into three slices
SLICED_EVENTS = """
    span AS (SELECT min(CAST(ts AS DATE)) AS lo,
                    date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 AS days FROM events),
    sliced AS (SELECT e.*, CAST((date_diff('day', lo, CAST(ts AS DATE)) * 3) // days AS BIGINT) AS batch_id,
                      CAST(props->>'$.k' AS INTEGER) AS k
               FROM events e, span)
"""
