"""Graph jobs on edges taken from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph
from ..operators.ordered import sliding
from .registry import Tables, query


def user_links(t: Tables) -> DataFrame:
    """An edge from the user of an event to the user of the next one."""
    e = t("events")
    following = e.select((F.col("event_id") - 1).alias("event_id"), F.col("user_id").alias("dst"))
    pairs = e.select("event_id", F.col("user_id").alias("src")).join(following, "event_id")
    return pairs.filter("src <> dst").groupBy("src", "dst").agg(F.min(1 + F.col("event_id") % 7).alias("weight"))


_LINKS = """
    e AS (SELECT a.user_id AS src, b.user_id AS dst, min(1 + a.event_id % 7) AS weight FROM events a JOIN events b ON b.event_id = a.event_id + 1
          WHERE a.user_id <> b.user_id GROUP BY 1, 2)
"""


def _rank_sql(edges: str, rounds: int) -> str:
    """Page rank written out round by round."""
    parts = [
        f"WITH {edges}",
        "w AS (SELECT e.src, e.dst, 1.0::DOUBLE / d.n AS part FROM e JOIN (SELECT src, count(*) AS n FROM e GROUP BY 1) d ON d.src = e.src)",
        "r0 AS (SELECT DISTINCT src AS id, 1.0::DOUBLE AS rank FROM e)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"r{i} AS MATERIALIZED (SELECT w.dst AS id, 0.15 + 0.85 * sum(r.rank * w.part) AS rank FROM w JOIN r{i - 1} r ON r.id = w.src GROUP BY 1)"
        )
    return ", ".join(parts)


def _distance_sql(rounds: int) -> str:
    parts = [f"WITH {_LINKS}", "d0 AS (SELECT 1::BIGINT AS id, 0.0::DOUBLE AS distance)"]
    for i in range(1, rounds + 1):
        parts.append(
            f"d{i} AS MATERIALIZED (SELECT id, min(distance) AS distance FROM (SELECT * FROM d{i - 1} UNION ALL "
            f"SELECT e.dst, d.distance + e.weight FROM d{i - 1} d JOIN e ON e.src = d.id) GROUP BY 1)"
        )
    return ", ".join(parts) + f" SELECT id, distance FROM d{rounds}"


@query("pagerank", _rank_sql(_LINKS, 5) + " SELECT id, round(rank, 8) AS rank FROM r5")
def pagerank(t: Tables) -> DataFrame:
    return graph.pagerank(user_links(t), 5).withColumn("rank", F.round("rank", 8))


@query(
    "connected_components",
    "SELECT event_id AS id, min(event_id) OVER (PARTITION BY user_id) AS component FROM events WHERE user_id IN "
    "(SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)",
)
def connected_components(t: Tables) -> DataFrame:
    """Chains of one user's events: long paths, one component per user."""
    chained = sliding(
        t("events").select("user_id", "event_id"), ["user_id"], [("event_id", True)],
        {"dst": lambda w: F.lead("event_id", 1).over(w)}, before=0, after=1,
    )
    edges = chained.filter("dst IS NOT NULL").select(F.col("event_id").alias("src"), "dst")
    return graph.connected_components(edges)


@query(
    "triangle_count",
    f"""
    WITH {_LINKS}, p AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e),
    t AS (SELECT x.a, x.b, y.b AS c FROM p x JOIN p y ON x.b = y.a JOIN p z ON z.a = x.a AND z.b = y.b),
    c AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t) GROUP BY 1)
    SELECT v.id, coalesce(n, 0)::BIGINT AS triangles FROM (SELECT src AS id FROM e UNION SELECT dst FROM e) v LEFT JOIN c ON c.id = v.id
    """,
)
def triangle_count(t: Tables) -> DataFrame:
    return graph.triangle_counts(user_links(t))


@query("shortest_paths", _distance_sql(30))
def shortest_paths(t: Tables) -> DataFrame:
    return graph.shortest_paths(user_links(t), 1)


@query(
    "transitive_closure",
    """
    SELECT a.conv_id * 10000 + a.turn AS src, b.conv_id * 10000 + b.turn AS dst
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn < b.turn
    """,
)
def transitive_closure(t: Tables) -> DataFrame:
    """Which turn comes after which: the reach of the reply links."""
    node = F.col("conv_id") * 10000 + F.col("turn")
    c = t("conversations")
    nodes = c.select("conv_id", "turn", node.alias("src"))
    following = c.select("conv_id", (F.col("turn") - 1).alias("turn"), node.alias("dst"))
    return graph.transitive_closure(nodes.join(following, ["conv_id", "turn"]).select("src", "dst"))


@query(
    "aggregate_messages",
    f"""
    WITH {_LINKS} SELECT dst AS id, count(*)::BIGINT AS older, round(avg(src * 37 % 61), 8) AS mean_age FROM e
    WHERE src * 37 % 61 > dst * 37 % 61 GROUP BY 1
    """,
)
def aggregate_messages(t: Tables) -> DataFrame:
    edges = user_links(t)
    vertices = t("events").select(F.col("user_id").alias("id")).distinct().withColumn("age", F.col("id") * 37 % 61)
    return graph.older_neighbours(vertices, edges).withColumn("mean_age", F.round("mean_age", 8))


_SUB = (
    _LINKS.replace("e AS (", "e0 AS (", 1)
    + ", v AS (SELECT c_custkey AS id, c_name FROM customer WHERE c_acctbal > 0), "
    + "e AS (SELECT src, dst FROM e0 WHERE src IN (SELECT id FROM v) AND dst IN (SELECT id FROM v))"
)


@query(
    "subgraph_join",
    _rank_sql(_SUB, 4) + " SELECT r4.id, round(rank, 8) AS rank, c_name FROM r4 JOIN v ON v.id = r4.id ORDER BY r4.rank DESC, r4.id LIMIT 5",
)
def subgraph_join(t: Tables) -> DataFrame:
    """Rank within a filtered graph, attributes joined back, top five."""
    vertices = t("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"), "c_name")
    inside = graph.subgraph(vertices, user_links(t)).select("src", "dst")
    ranks = graph.pagerank(inside, 4)
    out = ranks.join(vertices, "id").orderBy(F.col("rank").desc(), "id").limit(5)
    return out.withColumn("rank", F.round("rank", 8))


@query(
    "degrees",
    f"""
    WITH {_LINKS}, d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY 1)
    SELECT degree::BIGINT AS degree, count(*)::BIGINT AS vertices FROM d GROUP BY 1
    """,
)
def degrees(t: Tables) -> DataFrame:
    return graph.degree_histogram(user_links(t))
