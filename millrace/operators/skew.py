"""Hot keys: find them in one bounded pass, and salt joins on them.

``hot_keys`` uses the frequent-items sketch, whose result holds every key above
the support and never more than about ``1/support`` keys however large the
input is. That bound is what makes the broadcast of the hot keys safe.
"""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.scratch import cut

#: A partition of this size is what a task should get; a key above it is hot.
TARGET_BYTES = 128 << 20
#: Most hot keys that are looked for (the sketch takes no support below 1e-4; smaller keys are left to adaptive
#: execution), and fewest.
MOST_KEYS, FEWEST_KEYS = 10_000, 20
#: Salts where Spark has no estimate, which it tells by a size beyond all tables.
SALTS, UNKNOWN_BYTES = 64, 2.0**62

_UNITS = {"b": 0, "k": 10, "kb": 10, "kib": 10, "m": 20, "mb": 20, "mib": 20, "g": 30, "gb": 30, "gib": 30, "t": 40, "tb": 40, "tib": 40, "pib": 50, "eib": 60}


def _bytes(text: str) -> float:
    number, unit = re.fullmatch(r"(-?[\d.]+(?:E[+-]?\d+)?)\s*([a-zA-Z]*)", text.strip()).groups()
    return float(number) * 2.0 ** _UNITS[unit.lower() or "b"]


def estimated_bytes(df: DataFrame) -> float:
    """Spark's own estimate of the size of ``df``, as its explained plan tells it; where it tells none, Spark's default for an unknown size."""
    with contextlib.redirect_stdout(io.StringIO()) as told:
        df.explain("cost")
    found = re.search(r"sizeInBytes=([^,)]+)", told.getvalue())
    return _bytes(found[1]) if found else float((1 << 63) - 1)


def support_of(df: DataFrame) -> float:
    """The share of the rows that fills a target partition, within the bounds on the number of keys."""
    return min(1 / FEWEST_KEYS, max(1 / MOST_KEYS, TARGET_BYTES / max(1.0, estimated_bytes(df))))


def hot_keys(df: DataFrame, keys: Sequence[str], support: float | None = None) -> DataFrame:
    """Every key combination holding more than ``support`` of the rows (and perhaps a few more)."""
    support = support_of(df) if support is None else support
    if len(keys) == 1:
        (key,) = keys
        frequent = df.select(key).stat.freqItems([key], support)
        return frequent.select(F.explode(f"{key}_freqItems").alias(key))
    packed = df.select(F.struct(*keys).alias("key"))
    return (
        packed.stat.freqItems(["key"], support)
        .select(F.explode("key_freqItems").alias("key"))
        .select("key.*")
    )


def will_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate of ``df`` is below its broadcast threshold."""
    return estimated_bytes(df) <= _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def _with_salts(left: DataFrame, hot: DataFrame, keys: list[str], salts: int | None) -> DataFrame:
    """The hot keys with ``_salts``: target partitions that the rows of the key fill.

    Together they are no more than the target partitions of ``left``, plus two a key.
    """
    if salts is not None:
        return hot.withColumn("_salts", F.lit(salts))
    size, held = left.agg(F.count(F.lit(1))).first()[0], estimated_bytes(left)
    if held >= UNKNOWN_BYTES:
        return hot.withColumn("_salts", F.lit(SALTS))
    counted = left.select(*keys).join(F.broadcast(hot), keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") * F.lit(held / TARGET_BYTES / max(1, size))) + 1
    return counted.select(*keys, parts.cast("int").alias("_salts"))


def _flag(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(F.broadcast(hot), list(keys), "left")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    spread_by: Sequence[str],
    support: float | None = None,
    salts: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join whose left side may pile up on a few keys.

    A right side small enough for Spark to broadcast needs no exchange, and a left side of less than a target
    partition has no hot key: then nothing is salted. Otherwise left rows of a hot key are spread over as many partitions as they
    fill (or ``salts``) by ``spread_by`` (columns that tell its rows apart); the right rows of those keys, and only
    those, are repeated once per salt. Exact for inner, left, semi and anti joins,
    whatever the hot keys are. Finding and counting them reads the left side's keys again: where
    that side is itself a join, pass ``hot`` found on its input.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting keeps {how!r} joins exact only from the left side")
    keys = list(keys)
    given = support is not None or salts is not None or hot is not None
    if will_broadcast(right) or not given and estimated_bytes(left) <= TARGET_BYTES:
        return _ordered(left.join(right, keys, how), left, right, keys, how)
    hot = hot_keys(left, keys, support) if hot is None else hot
    # few rows that both sides read: written once
    hot = cut(_with_salts(left, hot, keys, salts))
    # a null key matches nothing, so its rows may go anywhere
    unmatched = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    anywhere = F.when(unmatched, F.lit(SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = _flag(left, hot, keys).withColumn(
        "_salt", F.when(anywhere > 1, F.pmod(F.xxhash64(*spread_by), anywhere)).otherwise(0).cast("int")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = _flag(right, hot, keys).withColumn("_salt", F.explode(copies))
    joined = salted_left.drop("_salts").join(salted_right.drop("_salts"), [*keys, "_salt"], how)
    return _ordered(joined, left, right, keys, how)


def _ordered(
    joined: DataFrame, left: DataFrame, right: DataFrame, keys: Sequence[str], how: str
) -> DataFrame:
    """The left columns as they were, then what the right side adds."""
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    return joined.select(*left.columns, *added)


def chunk_of(row_id: Column, group_rows: Column, chunk_rows: int) -> Column:
    """Chunk number that cuts a group of ``group_rows`` rows into pieces of about ``chunk_rows``."""
    # a hash first: ids with a common step would all fall in a few chunks
    spread = F.conv(F.substring(F.md5(row_id.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(spread, F.ceil(group_rows / F.lit(chunk_rows))).cast("long")
