"""Graph jobs with few salted keys, contracted parts and coloured triangles."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from marlstone.operators import graph

EDGES = "src long, dst long"


def _pairs(seed, n, vertices):
    rng = random.Random(seed)
    # vertex 0 holds a third of all edges
    return [(0 if rng.random() < 0.33 else rng.randrange(vertices), rng.randrange(vertices)) for _ in range(n)]


@pytest.mark.parametrize("most", [3, 40, 2_000_000])
def test_triangles_of_every_colour(spark, monkeypatch, most):
    monkeypatch.setattr(graph, "TRIANGLE_EDGES", most)
    pairs = _pairs(2, 150, 24)
    around = {}
    for a, b in pairs:
        around.setdefault(a, set())
        around.setdefault(b, set())
        if a != b:
            around[a].add(b)
            around[b].add(a)
    want = {v: sum(c in around[b] for b, c in combinations(sorted(near), 2)) for v, near in around.items()}
    if most == 3:  # 18 colours
        pairs = pairs + pairs[:9]
    got = graph.triangle_counts(spark.createDataFrame(pairs, EDGES))
    assert {r["id"]: r["triangles"] for r in got.collect()} == want and sum(want.values()) > 100


def test_no_path_of_two_edges_is_shuffled(spark):
    """The only joins bring the counts to the vertices."""
    plan = graph.triangle_counts(spark.createDataFrame(_pairs(1, 40, 9), EDGES))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


@pytest.mark.parametrize("local, hot", [(1, 2), (5, 10), (1_000_000, 200_000)])
def test_components_from_contracted_parts(spark, monkeypatch, local, hot):
    monkeypatch.setattr(graph, "LOCAL_EDGES", local)
    monkeypatch.setattr(graph, "HOT_ROWS", hot)
    pairs = [(i, i + 1) for i in range(50, 90)] + _pairs(3, 25, 40) + [(200, 200), (300, None), (None, 301)]
    random.Random(1).shuffle(pairs)
    parent = {}

    def find(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        if None not in (a, b):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        else:
            find(a if b is None else b)
    got = [tuple(r) for r in graph.connected_components(spark.createDataFrame(pairs, EDGES).repartition(4)).collect()]
    assert len(got) == len(set(got)) and dict(got) == {v: find(v) for v in list(parent)} | {None: None}


def test_only_hot_keys_are_repeated(spark, monkeypatch):
    monkeypatch.setattr(graph, "HOT_ROWS", 10)
    many = spark.createDataFrame([(0, i) for i in range(100)] + [(1, 5), (2, 6), (None, 7)], EDGES)
    assert graph.hot_keys(graph.rows_per(many, "src"), "src") == [0]
    assert graph.per_salt(spark.range(50), "id", [0]).count() == 49 + graph.SALTS
    names = spark.range(3).select(F.col("id").alias("src"), F.col("id").cast("string").alias("name"))
    for how in ("inner", "left_semi"):
        got = graph.spread_join(many, names, "src", "dst", how)
        assert sorted((r["src"], r["dst"]) for r in got.collect()) == sorted([(0, i) for i in range(100)] + [(1, 5), (2, 6)])
