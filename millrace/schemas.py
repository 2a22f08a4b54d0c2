"""Schemas of the input domains (DDL text where only readers need them), and schemas declared
in JSON files."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

COMMENT = "author string, subreddit string, body string, created_utc string"

TRIP = (
    "tripduration int, starttime string, start_station string, end_station string, "
    "usertype string, birth_year string"
)

QUOTE_DOCUMENT = (
    "query struct<created: string, results: struct<quote: array<struct<"
    "symbol: string, LastTradePriceOnly: string, Volume: string>>>>"
)

STATION_DOCUMENT = (
    "stationBeanList array<struct<id: int, stationName: string, statusValue: string, statusKey: int>>"
)

CDR = T.StructType(
    [
        T.StructField("squareId", T.IntegerType(), False),
        T.StructField("timeInterval", T.LongType(), False),
        T.StructField("countryCode", T.IntegerType()),
        T.StructField("smsInActivity", T.FloatType()),
        T.StructField("smsOutActivity", T.FloatType()),
        T.StructField("callInActivity", T.FloatType()),
        T.StructField("callOutActivity", T.FloatType()),
        T.StructField("internetTrafficActivity", T.FloatType()),
    ]
)

#: the same records with the country code kept as text
CDR_TEXT_COUNTRY = T.StructType(
    [T.StructField(f.name, T.StringType()) if f.name == "countryCode" else f for f in CDR]
)

GRID_DOCUMENT = (
    "features array<struct<id: long, geometry: struct<coordinates: array<array<array<double>>>>>>"
)

#: sensor features used by the regression pipeline
ACTIVITY = (
    "label double, hand_x double, hand_y double, hand_z double, chest_x double, chest_y double, "
    "chest_z double, ankle_x double, ankle_y double, ankle_z double"
)

RATING = "subject int, activity int, freq double"

BUSINESS = "attributes struct<`Wi-Fi`: string>, stars double"

REVIEW = "business_id string, date string, stars int"

FRIENDS = "user_id string, friends array<string>"


def from_json_file(spark: SparkSession, path: str) -> T.StructType:
    """Load a schema document (the ``StructType`` JSON form) from any file system."""
    document = spark.read.text(path, wholetext=True).first()
    return T.StructType.fromJson(json.loads(document["value"]))


def as_text(names: Iterable[str]) -> T.StructType:
    """All-string schema for positional text records."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])
