"""Graphs, learning, charts and streams against brute force on small inputs."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import charts, geography, graph, learning, pivots, relational
from marlstone.streaming import jobs, runner


def edges_of(spark, pairs, weights=None):
    rows = [(a, b, float(w)) for (a, b), w in zip(pairs, weights or [1.0] * len(pairs))]
    return spark.createDataFrame(rows, "src long, dst long, weight double")


@pytest.fixture(scope="module")
def random_pairs():
    rnd = random.Random(4)
    # vertex 0 holds a third of all edges
    return [(0 if rnd.random() < 0.33 else rnd.randrange(30), rnd.randrange(30, 60)) for _ in range(60)] + [(100, 101), (102, 103)]


def test_components(spark, random_pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in random_pairs:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r["id"]: r["component"] for r in graph.connected_components(edges_of(spark, random_pairs)).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_no_partial_results(spark):
    chain = edges_of(spark, [(i, i + 1) for i in range(40)])
    with pytest.raises(RuntimeError):
        graph.connected_components(chain, max_rounds=1)
    with pytest.raises(RuntimeError):
        graph.pagerank(chain, tolerance=1e-12, max_iterations=1)
    with pytest.raises(RuntimeError):
        graph.shortest_paths(chain.withColumn("weight", F.lit(1.0)), 0, max_rounds=2)
    assert {r["component"] for r in graph.connected_components(chain).collect()} == {0}


def test_closure_of_some_sources(spark):
    edges = edges_of(spark, [(1, 2), (2, 3), (3, 4), (5, 1)])
    one = spark.createDataFrame([(1,)], "id long")
    assert {tuple(r) for r in graph.transitive_closure(edges, one).collect()} == {(1, 2), (1, 3), (1, 4)}
    assert {tuple(r) for r in graph.transitive_closure(edges, depth=2).collect()} == {(1, 2), (2, 3), (3, 4), (5, 1), (1, 3), (2, 4), (5, 2)}


def test_components_keep_self_loops(spark):
    got = {r["id"]: r["component"] for r in graph.connected_components(edges_of(spark, [(7, 7), (1, 2)])).collect()}
    assert got == {7: 7, 1: 1, 2: 1}


def test_shortest_paths(spark, random_pairs):
    rnd = random.Random(1)
    pairs = random_pairs + [(b, a) for a, b in random_pairs]
    weights = [rnd.randrange(1, 9) for _ in pairs]
    best = {0: 0.0}
    for _ in range(100):
        for (a, b), w in zip(pairs, weights):
            if a in best and best[a] + w < best.get(b, math.inf):
                best[b] = best[a] + w
    got = {r["id"]: r["distance"] for r in graph.shortest_paths(edges_of(spark, pairs, weights), 0).collect()}
    assert got == best


def test_closure(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (4, 5)]
    got = {(r["src"], r["dst"]) for r in graph.transitive_closure(edges_of(spark, pairs)).collect()}
    assert got == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3)} | {(4, 5)}


def test_pagerank_with_and_without_sources(spark):
    pairs = [(1, 2), (2, 3), (3, 2), (4, 2)]
    edges = edges_of(spark, pairs)
    some = {r["id"] for r in graph.pagerank(edges, 3).collect()}
    every = {r["id"]: r["rank"] for r in graph.pagerank(edges, 3, keep_all=True).collect()}
    assert some == {2, 3} and set(every) == {1, 2, 3, 4} and every[1] == pytest.approx(0.15)
    settled = {r["id"]: r["rank"] for r in graph.pagerank(edges, tolerance=1e-2, keep_all=True, damping=0.5).collect()}
    assert settled[2] == pytest.approx(0.5 + 0.5 * (settled[1] + settled[3] + settled[4]), abs=2e-2)


def test_event_paths(spark):
    rnd = random.Random(2)
    rows = [(e, rnd.choice("ab"), i) for e in range(12) for i in range(rnd.randrange(1, 6))]
    df = spark.createDataFrame(rows, "who long, what string, at long")
    want = defaultdict(int)
    for e in range(12):
        seq = [w for x, w, i in sorted(rows, key=lambda r: (r[0], r[2])) if x == e]
        for n in range(1, len(seq) + 1):
            want[" > ".join(seq[:n])] += 1
    for least in (3, 1):
        got = {r["path"]: r["entities"] for r in charts.event_paths(df, "who", "what", "at", "at", least).collect()}
        assert got == {k: v for k, v in want.items() if v >= least}


def test_p_values():
    # two-sided values of Student's t from published tables
    for t, freedom, p in ((2.228, 10, 0.05), (2.845, 20, 0.01), (1.96, 10_000_000, 0.05), (0.0, 5, 1.0)):
        assert charts.two_sided_p(t, freedom) == pytest.approx(p, abs=2e-4)
    assert charts.two_sided_p(None, 3) is None


def test_self_loops_count_twice(spark):
    df = spark.createDataFrame([("a", "a", 2.0), ("a", "b", 1.0), ("b", "c", 0.0), ("c", "a", None)], "s string, t string, v double")
    got = {r["node"]: r["total"] for r in charts.node_totals(df, "s", "t", "v").collect()}
    assert got == {"a": 5.0, "b": 1.0}


def test_open_annotations(spark):
    rows = spark.createDataFrame([(datetime(2020, 1, d),) for d in range(1, 6)], "ts timestamp_ntz")
    notes = spark.createDataFrame(
        [(datetime(2020, 1, 2), datetime(2020, 1, 4), "span"), (datetime(2020, 1, 3), None, "point")],
        "start_dttm timestamp_ntz, end_dttm timestamp_ntz, short_descr string",
    )
    got = sorted((r["ts"].day, r["short_descr"]) for r in charts.interval_annotations(rows, "ts", notes).collect())
    assert got == [(2, "span"), (3, "point"), (3, "span"), (4, "span")]


def test_hexagons_take_the_nearest_centre(spark):
    rnd = random.Random(3)
    size = 10.0
    points = [(i, rnd.uniform(-100, 100), rnd.uniform(-100, 100)) for i in range(300)]
    df = spark.createDataFrame(points, "i int, x double, y double")
    q, r = geography.hex_cell(F.col("x"), F.col("y"), size)
    for row in df.select("x", "y", q.alias("q"), r.alias("r")).collect():
        def gap(a, b):
            cx, cy = size * math.sqrt(3) * (a + b / 2), size * 1.5 * b
            return math.hypot(row["x"] - cx, row["y"] - cy)

        around = [gap(row["q"] + a, row["r"] + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
        assert gap(row["q"], row["r"]) <= min(around) + 1e-9


def test_degenerate_bounds(spark):
    df = spark.createDataFrame([(180.0, 90.0), (180.0, 90.0)], "lon double, lat double")
    assert tuple(geography.bounds(df, "lon", "lat").first()) == (179.75, 180.0, 89.75, 90.0)


def test_variance_of_one_row_is_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0)], "k string, v double")
    got = {r["k"]: r["value"] for r in pivots.pivot_long(df, ["k"], "v", "Sample Variance").collect()}
    assert got == {"a": 0.0, "b": 2.0}


def test_natural_order(spark):
    df = spark.createDataFrame([("a10", 1), ("a9", 2), ("a1b2", 3), ("b", 4)], "k string, v int")
    assert [r["k"] for r in pivots.pivot_sort(df, "k", "v").collect()] == ["a1b2", "a9", "a10", "b"]


def test_lookup_is_broadcast_by_its_bytes(spark):
    left = spark.range(1000).select((F.col("id") % 10).alias("k"))
    small = spark.range(10).select(F.col("id").alias("i"))
    plan = lambda: relational.lookup_join(left, small, "k", "i")._jdf.queryExecution()
    assert "BroadcastHashJoin" in plan().executedPlan().toString() and "ResolvedHint" not in plan().logical().toString()
    wide = spark.range(2000).select(F.col("id").alias("i"), F.repeat(F.lit("w"), 20_000).alias("text"))
    assert relational.lookup_join(left, wide, "k", "i").count() == 1000


def test_samples(spark):
    df = spark.range(1000)
    assert relational.take_sample(df, 50, 3).distinct().count() == 50
    drawn = relational.take_sample_replaced(df.limit(20), "id", 200, 3)
    assert drawn.count() == 200 and drawn.distinct().count() <= 20


def test_near_passages_find_copies(spark):
    base = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(i, base) for i in range(30)] + [(99, "quite another text altogether here")], "doc long, text string")
    items = spark.createDataFrame([(1, base + " eleven"), (2, "nothing in common at all")], "item long, text string")
    got = {(r["doc"], r["item"]) for r in learning.near_passages(docs, items, "doc", "item", "text", 0.5).collect()}
    assert got == {(i, 1) for i in range(30)}


def test_nearest_recall(spark, tables):
    vectors = {r["vec_id"]: np.array(r["embedding"]) for r in tables("embeddings").collect()}
    exact = sorted(vectors, key=lambda i: np.linalg.norm(vectors[i] - vectors[0]))[:5]
    got = [r["vec_id"] for r in learning.nearest(tables("embeddings"), "vec_id", 0, 5).collect()]
    assert got[0] == 0 and len(set(got) & set(exact)) >= 3


def test_singular_values(spark, tables):
    sigma, vectors = learning.singular_values(tables("embeddings"), "embedding", 4)
    x = np.stack([np.array(r["embedding"]) for r in tables("embeddings").collect()])
    want = np.linalg.svd(x, compute_uv=False)[:4]
    assert [r["sigma"] for r in sigma.orderBy("rank").collect()] == pytest.approx(list(want), rel=1e-5)
    assert vectors.T @ vectors == pytest.approx(np.eye(4), abs=1e-8)


def test_gradient_descent_agrees_with_the_library(spark):
    from pyspark.ml.classification import LogisticRegression

    rnd = random.Random(5)
    rows = []
    for _ in range(400):
        x = rnd.uniform(-1, 1)
        rows.append((x, float(rnd.random() < 1 / (1 + math.exp(-(3 * x + 0.5))))))
    df = spark.createDataFrame(rows, "x double, y double")
    got = {r["feature"]: r["weight"] for r in learning.logistic_descent(df, ["x"], "y", 40, 6.0).collect()}
    model = LogisticRegression(labelCol="y", maxIter=50, standardization=False).fit(learning.assembled(df, ["x"]))
    assert got["x"] == pytest.approx(model.coefficients[0], abs=0.1) and got["intercept"] == pytest.approx(model.intercept, abs=0.1)


def test_streaming_centres_converge(spark):
    rnd = random.Random(6)
    rows = [(i, [c + rnd.gauss(0, 0.1), -c + rnd.gauss(0, 0.1)]) for i, c in enumerate([0.0, 5.0] * 100)]
    df = spark.createDataFrame(rows, "i long, v array<double>")
    stream = runner.stream_files(spark, runner.land(df, "i", 4, "blobs"), 1)
    centres = sorted(r["centre"] for r in learning.stream_k_means(stream, "v", [[1.0, 0.0], [4.0, -3.0]], 0.9, "blob-centres").collect())
    assert centres[0] == pytest.approx([0, 0], abs=0.1) and centres[1] == pytest.approx([5, -5], abs=0.1)


def test_streaming_line(spark):
    df = spark.range(400).select("id", (F.rand(1) * 2 - 1).alias("x")).select("id", "x", (2 * F.col("x") + 1).alias("y"))
    stream = runner.stream_files(spark, runner.land(df, "id", 3, "line"), 1)
    w = [r["weight"] for r in learning.stream_regression(stream, ["x"], "y", 0.8, 15, "line-weights").sort("place").collect()]
    assert w == pytest.approx([1.0, 2.0], abs=0.05)


def test_late_rows_are_dropped(spark, tmp_path):
    start = datetime(2024, 1, 1)
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    schema = "ts timestamp, k string"

    def land(*minutes):
        spark.createDataFrame([(start + timedelta(minutes=m), "a") for m in minutes], schema).write.mode("append").parquet(path)

    def run():
        stream = spark.readStream.schema(schema).parquet(path).withWatermark("ts", "10 minutes")
        runner.run_append(jobs.window_counts(stream, "ts", ["k"], "10 minutes"), "late", out, checkpoint)

    land(1, 2, 45)
    run()
    land(3, 46, 90)  # minute 3 is behind the mark of 35
    run()
    rows = spark.read.parquet(out).select(F.col("window.start").alias("s"), "n").collect()
    assert {((r["s"] - start).seconds // 60, r["n"]) for r in rows} == {(0, 2), (40, 2)}


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).write.mode("append").parquet(path)
        runner.run_append(runner.stream_files(spark, path), "again", out, checkpoint)
        runner.run_append(runner.stream_files(spark, path), "again", out, checkpoint)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(30))


def test_sessions_over_several_batches(spark, tmp_path):
    """Stateful sessions equal a plain gaps-and-islands pass, whatever the cut into batches."""
    rnd = random.Random(8)
    start = datetime(2024, 1, 1)
    rows = sorted((start + timedelta(minutes=rnd.randrange(3000)), rnd.choice([1, 1, 1, 2, 3])) for _ in range(300))
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def each(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    for part in range(3):
        piece = rows[part * 100:(part + 1) * 100]
        spark.createDataFrame(piece, "ts timestamp, user_id long").write.mode("append").parquet(path)
        updates = jobs.session_updates(runner.stream_files(spark, path), "ts", "user_id", 1800, "1 minute")
        runner.run_batches(updates, each, "sessions", "update", checkpoint)
    want = []
    mark = rows[-1][0] - timedelta(minutes=1)
    for user in (1, 2, 3):
        times = [t for t, u in rows if u == user]
        group = [times[0]]
        for t in times[1:]:
            if (t - group[-1]).total_seconds() >= 1800:
                want.append((user, len(group), (group[-1] - group[0]).total_seconds()))
                group = []
            group.append(t)
        if group[-1] + timedelta(minutes=30) <= mark:
            want.append((user, len(group), (group[-1] - group[0]).total_seconds()))
    got = [tuple(r) for r in spark.read.parquet(out).filter("expired").select("user_id", "events", "duration").collect()]
    assert sorted(got) == sorted(want)
