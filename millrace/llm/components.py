"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import cut

#: Children of one node that a task gets at least before they are dealt out, and most nodes dealt out in a step (a broadcast of
#: two numbers each).
PART, HOT = 500, 10_000


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every edge ``(child, parent)`` moved to the least parent of its parent, where that has one.

    The children of a node that many point to are dealt into parts, each with a copy of that node's row.
    """
    above = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    most = max(PART, n // HOT)
    counted = edges.groupBy("v").agg(F.count("*").alias("n")).filter(F.col("n") > most)
    hot = F.broadcast(counted.select("v", F.ceil(F.col("n") / most).cast("long").alias("parts")))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    children = edges.join(hot, "v", "left").select("u", "v", F.pmod(F.xxhash64("u"), F.coalesce("parts", one)).alias("part"))
    copies = above.join(hot, "v", "left").select("v", "m", F.explode(F.sequence(zero, F.coalesce("parts", one) - 1)).alias("part"))
    return children.join(copies, ["v", "part"], "left").select("u", F.coalesce("m", "v").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return linked.select(F.col("u"), F.col("m").alias("v")).unionByName(
        linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes with an edge other than the least of their component.

    ``edges`` has long columns ``u, v``; loops and repetitions are fine. Every step keeps at most one row per edge; the
    steps end when all edges point to the least node of their component.
    """
    state = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
        state = cut(_small_star(_large_star(state, now[0])).filter("u <> v").distinct())
