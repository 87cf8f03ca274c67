"""Outer stream joins, tests and learning over micro-batches, with stops in between."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marlstone.operators import learning
from marlstone.streaming import jobs, runner

START = datetime(2024, 1, 1)


def feed(spark, path, schema, parts):
    """A file per part, in order."""
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return runner.stream_files(spark, path, 1, spark.createDataFrame([], schema).schema)


# --- outer joins -------------------------------------------------------------


def both_sides(seed):
    """Views and purchases by batch: (key, minute, id); the last batch only moves the watermark."""
    rng = random.Random(seed)
    sides = []
    for side in (0, 1):
        parts, number = [], 1000 * side
        for batch in range(4):
            rows = []
            for _ in range(25):
                number += 1
                rows.append((rng.choice("aaab"), batch * 100 + rng.randint(0, 99), number))
            parts.append(rows)
        parts.append([("z", 2000, number + 1)])
        sides.append(parts)
    return sides


@pytest.mark.parametrize("how", ["inner", "left_outer", "right_outer", "full_outer"])
def test_stream_joins_equal_batch_joins(spark, tmp_path, how):
    views, buys = both_sides(5)
    # A late row on each side: older than the watermark once its batch comes, so it is dropped.
    late = [[*views[0]], *views[1:3], [*views[3], ("a", 5, 77)], views[4]], [*buys[:3], [*buys[3], ("a", 6, 78)], buys[4]]

    def side(parts, name, time, label):
        rows = [[(k, START + timedelta(minutes=m), i) for k, m, i in p] for p in parts]
        return feed(spark, f"{tmp_path}/{label}", f"k string, {time} timestamp, {name} int", rows).withWatermark(time, "10 minutes")

    joined = jobs.join_within(side(late[0], "v", "tv", "views"), side(late[1], "p", "tp", "buys"), "k", "tv", "tp", 1800, how)
    out = runner.run_append(joined.select("v", "p"), "outer")
    got = sorted(tuple(-1 if x is None else x for x in r) for r in spark.read.schema("v int, p int").parquet(out).collect())
    v, p = [r for part in views for r in part], [r for part in buys for r in part]
    pairs = [(a[2], b[2]) for a in v for b in p if a[0] == b[0] and 0 <= b[1] - a[1] <= 30]
    want = list(pairs)
    # The last rows move the watermark to ten minutes before them; what lies behind it is settled.
    if how in ("left_outer", "full_outer"):
        want += [(a[2], -1) for a in v if a[2] not in {x for x, _ in pairs} and a[1] < 1900]
    if how in ("right_outer", "full_outer"):
        want += [(-1, b[2]) for b in p if b[2] not in {y for _, y in pairs} and b[1] < 1900]
    assert got == sorted(want) and len(pairs) > 20


def test_full_joins_need_different_names(spark):
    df = spark.createDataFrame([], "k string, t timestamp")
    with pytest.raises(ValueError, match="different names"):
        jobs.join_within(df, df, "k", "t", "t", 60, "full_outer")
    with pytest.raises(ValueError, match="unknown way"):
        jobs.join_within(df, df, "k", "t", "t", 60, "cross")


# --- tests of two labels -----------------------------------------------------


def welch_of(rows):
    a, b = ([v for k, v in rows if k == w] for w in ("a", "b"))
    if min(len(a), len(b)) < 2:
        return None, None, len(a), len(b)
    mean = lambda x: sum(x) / len(x)
    part = lambda x: sum((v - mean(x)) ** 2 for v in x) / (len(x) - 1) / len(x)
    s, t = part(a), part(b)
    return (mean(a) - mean(b)) / math.sqrt(s + t), (s + t) ** 2 / (s**2 / (len(a) - 1) + t**2 / (len(b) - 1)), len(a), len(b)


def labelled(seed, batches=6):
    rng = random.Random(seed)
    parts = [[(rng.choice("ab"), 1e6 + rng.gauss(k, 2)) for _ in range(rng.randint(5, 30))] for k in range(batches)]
    parts[3] = [("a", 5.0)]
    return parts


@pytest.mark.parametrize("peace,window", [(0, 0), (2, 0), (0, 1), (1, 2), (2, 3), (9, 2)])
def test_every_test_takes_its_own_batches(spark, tmp_path, peace, window):
    parts = labelled(peace * 10 + window)
    if peace == 9:
        with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
            jobs.ab_test(feed(spark, f"{tmp_path}/in", "k string, v double", parts[:2]), "k", "v", "a", "b", peace, window, "ab").collect()
        return
    got = jobs.ab_test(feed(spark, f"{tmp_path}/in", "k string, v double", parts), "k", "v", "a", "b", peace, window, "ab").sort("batch").collect()
    assert [r["batch"] for r in got] == list(range(peace, len(parts)))
    for r in got:
        first = max(peace, r["batch"] - window + 1) if window else peace
        t, freedom, n, m = welch_of([x for p in parts[first : r["batch"] + 1] for x in p])
        assert (r["n_first"], r["n_second"]) == (n, m)
        assert (r["t_statistic"], r["freedom"]) == ((None, None) if t is None else (pytest.approx(t, abs=1e-6), pytest.approx(freedom, rel=1e-6)))


def test_tests_go_on_after_a_stop(spark, tmp_path):
    parts = labelled(4)
    places = {"path": f"{tmp_path}/out", "checkpoint": f"{tmp_path}/cp"}
    for upto in (2, 5, 6):
        stream = feed(spark, f"{tmp_path}/in", "k string, v double", parts[{2: 0, 5: 2, 6: 5}[upto] : upto])
        got = jobs.ab_test(stream, "k", "v", "a", "b", 1, 0, "ab", **places).sort("batch").collect()
    whole = jobs.ab_test(feed(spark, f"{tmp_path}/again", "k string, v double", parts), "k", "v", "a", "b", 1, 0, "ab").sort("batch").collect()
    assert got == whole and len(got) == 5


# --- learning ----------------------------------------------------------------


def test_centres_survive_a_stop_and_a_repeated_batch(spark, tmp_path):
    rng = random.Random(2)
    parts = [[(i, [c + rng.gauss(0, 0.3), -c]) for i, c in enumerate([0.0, 5.0] * 20)] for _ in range(3)]
    schema, start = "i int, v array<double>", [[1.0, 0.0], [4.0, -3.0]]
    whole = learning.stream_k_means(feed(spark, f"{tmp_path}/a", schema, parts), "v", start, 0.8, "km").sort("cluster").collect()
    places = {"path": f"{tmp_path}/state", "checkpoint": f"{tmp_path}/cp"}
    learning.stream_k_means(feed(spark, f"{tmp_path}/b", schema, parts[:1]), "v", start, 0.8, "km", **places)
    # A batch that wrote its state and was stopped before it counted as done comes again.
    half = spark.createDataFrame([(0, [9.0, 9.0], 99.0), (1, [8.0, 8.0], 99.0)], "cluster int, centre array<double>, weight double")
    half.write.parquet(f"{tmp_path}/state/batch=1")
    got = learning.stream_k_means(feed(spark, f"{tmp_path}/b", schema, parts[1:]), "v", start, 0.8, "km", **places).sort("cluster").collect()
    assert got == whole and whole[0]["weight"] == pytest.approx(20 * (1 + 0.8 + 0.64))
    # Nothing new: the state stays.
    again = learning.stream_k_means(runner.stream_files(spark, f"{tmp_path}/b", 1, spark.createDataFrame([], schema).schema), "v", start, 0.8, "km", **places)
    assert again.sort("cluster").collect() == whole


@pytest.mark.parametrize("logistic", [False, True])
def test_weights_survive_a_stop(spark, tmp_path, logistic):
    rng = random.Random(3)
    parts = [[(x, float(2 * x + 1 > 0) if logistic else 2 * x + 1) for x in (rng.uniform(-1, 1) for _ in range(40))] for _ in range(3)]
    options = {"features": ["x"], "label": "y", "rate": 0.5, "steps": 4, "name": "line", "logistic": logistic}
    whole = learning.stream_regression(feed(spark, f"{tmp_path}/a", "x double, y double", parts), **options).sort("place").collect()
    for k in range(3):
        got = learning.stream_regression(feed(spark, f"{tmp_path}/b", "x double, y double", parts[k : k + 1]), path=f"{tmp_path}/state", checkpoint=f"{tmp_path}/cp", **options)
    assert [r["weight"] for r in got.sort("place").collect()] == pytest.approx([r["weight"] for r in whole])
    assert [r["feature"] for r in whole] == ["intercept", "x"] and whole[1]["weight"] > 0.3


def test_learning_without_rows(spark, tmp_path):
    stream = feed(spark, f"{tmp_path}/a", "x double, y double", [[]])
    assert [r["weight"] for r in learning.stream_regression(stream, ["x"], "y", 0.5, 2, "none").collect()] == [0.0, 0.0]
    assert F is not None
