"""Run a query and its SQL check side by side on one scale."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, case, sf_dir: str) -> str | None:
    """None when both sides agree in names, types and values; else what differs."""
    df = case.run(spark, sf_dir)
    got_names, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(case.sql)
    names, want = _sorted([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != names:
        return f"columns {got_names} != {names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a} != {b}"
    return None
