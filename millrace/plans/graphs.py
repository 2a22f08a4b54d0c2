"""The friend graph: every event names two friends of its user, some of them unknown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import graph
from millrace.plans.base import Cases, events, k_of_props

CASES = Cases()


def _friends(spark: SparkSession, sf: str) -> DataFrame:
    k = k_of_props().cast("long")
    return events(spark, sf).select("user_id", F.array(k * 2, k).alias("friends"))


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(F.col("user_id").alias("id")).distinct()


EDGES = """edges AS (SELECT user_id AS src, unnest([k * 2, k]) AS dst
                     FROM (SELECT user_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events)),
           users AS (SELECT DISTINCT user_id AS id FROM events),
           inside AS (SELECT src, dst FROM edges WHERE src IN (SELECT id FROM users) AND dst IN (SELECT id FROM users))"""


@CASES.query("graph_edges", f"WITH {EDGES} SELECT src, dst FROM edges")
def edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.edges(_friends(spark, sf), "user_id", "friends")


@CASES.query("graph_subgraph", f"WITH {EDGES} SELECT src, dst FROM inside")
def subgraph(spark: SparkSession, sf: str) -> DataFrame:
    return graph.subgraph(edges(spark, sf), _users(spark, sf))


def _ranks_sql(go_on: str) -> str:
    return f"""WITH RECURSIVE {EDGES},
        degree AS (SELECT src, count(*) AS d FROM inside GROUP BY src),
        weighted AS (SELECT i.src, i.dst, CAST(count(*) AS DOUBLE) / any_value(d) AS w
                     FROM inside i JOIN degree g ON g.src = i.src GROUP BY i.src, i.dst),
        pr(round, id, rank, moved) AS (
            SELECT 0, id, CAST(1 AS DOUBLE), CAST(1 AS DOUBLE) FROM users
            UNION ALL
            SELECT round + 1, id, new_rank, max(abs(new_rank - rank)) OVER ()
            FROM (SELECT p.round, p.id, p.rank, p.moved,
                         0.15::DOUBLE + 0.85::DOUBLE * coalesce(f.inflow, 0) AS new_rank
                  FROM pr p LEFT JOIN (SELECT dst, sum(q.rank * w) AS inflow
                                       FROM pr q JOIN weighted ON src = q.id GROUP BY dst) f ON f.dst = p.id
                  WHERE {go_on}))
        SELECT id, rank FROM pr WHERE round = (SELECT max(round) FROM pr)"""


_ROUNDS = 10


@CASES.query("graph_pagerank", f"SELECT id, round(rank, 6) AS rank FROM ({_ranks_sql(f'p.round < {_ROUNDS}')})")
def pagerank(spark: SparkSession, sf: str) -> DataFrame:
    """A fixed number of rounds."""
    ranks = graph.pagerank(subgraph(spark, sf), _users(spark, sf), tolerance=None, max_rounds=_ROUNDS)
    return ranks.select("id", F.round("rank", 6).alias("rank"))


@CASES.query(
    "graph_top_rank",
    f"""SELECT id, 'user ' || CAST(id AS VARCHAR) AS name, round(rank, 6) AS rank
        FROM ({_ranks_sql('p.moved > 0.0001')}) ORDER BY rank DESC, id LIMIT 10""",
)
def top_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks to a tolerance of 0.0001, attached to the users' names."""
    ranks = graph.pagerank(subgraph(spark, sf), _users(spark, sf), tolerance=1e-4)
    names = _users(spark, sf).withColumn("name", F.concat(F.lit("user "), "id"))
    top = graph.top_ranked(names, ranks.withColumn("rank", F.round("rank", 6)), 10)
    return top.select("id", "name", "rank")
