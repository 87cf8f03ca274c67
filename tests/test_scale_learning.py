"""Learning steps that must not compare all with all or pass a vocabulary through the driver."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import learning, ordered


@pytest.mark.parametrize("rows", [7, 100_000])
def test_top_products_against_all(spark, monkeypatch, rows):
    monkeypatch.setattr(learning, "CONE_ROWS", rows)
    monkeypatch.setattr(learning, "CONES", 16)
    rng = np.random.default_rng(3)
    u, x = (rng.normal(size=(n, 3)).astype(np.float32) for n in (150, 400))
    u[5] = 0
    x[10:14] = x[20]  # ties
    left, right = (spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<float>").repartition(3) for m in (u, x))
    got = {}
    for r in learning.top_products(left, right, 3).collect():
        got.setdefault(r["left"], []).append((-r["product"], r["right"]))
    scores = learning._products(u, x)
    want = {i: [(-float(s[j]), int(j)) for j in np.lexsort((np.arange(len(x)), -s))[:3]] for i, s in enumerate(scores)}
    assert {i: sorted(v) for i, v in got.items()} == want
    few = learning.top_products(left, right.filter("id < 2"), 3)
    assert few.count() == 300 and few.dtypes == [("left", "int"), ("right", "int"), ("product", "float")]
    assert learning.top_products(left, right.filter("id < 0"), 3).count() == learning.top_products(left.limit(0), right, 3).count() == 0


def test_top_products_leaves_most_pairs_out(spark, monkeypatch):
    compared = spark.sparkContext.accumulator(0)
    plain = learning._products

    def counting(u, x):
        compared.add(len(u) * len(x))
        return plain(u, x)

    monkeypatch.setattr(learning, "_products", counting)
    rng = np.random.default_rng(4)
    left, right = (spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(3, 1, size=(n, 4)))], "id int, features array<float>") for n in (2000, 5000))
    assert learning.top_products(left, right, 3).count() == 6000
    assert compared.value < 0.1 * 2000 * 5000


@pytest.mark.parametrize("chunk_rows", [1_000_000, 20])
def test_rank_correlation(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", chunk_rows)
    rng = np.random.default_rng(6)
    a = rng.integers(0, 7, 300) / 2
    b = np.round(a + rng.normal(0, 2, 300), 1)

    def ranks(v):
        return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])

    rows = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "x double, y double")
    got = learning.rank_correlation(rows, "x", "y")
    assert got.first()["spearman"] == pytest.approx(np.corrcoef(ranks(a), ranks(b))[0, 1], abs=1e-9)
    assert np.isnan(learning.rank_correlation(rows.withColumn("y", F.lit(1.0)), "x", "y").first()["spearman"])


def test_huffman_runs_are_a_huffman_tree():
    rng = np.random.default_rng(8)
    for trial in range(60):
        counts = rng.integers(1, 30, rng.integers(1, 40)) ** (1 + trial % 2)
        classes = sorted((int(w), int((counts == w).sum())) for w in set(counts.tolist()))
        first, tree = learning.huffman_runs(classes)
        leaves = np.concatenate([first[w] + np.arange(n) for w, n in classes])
        weights = np.concatenate([[w] * n for w, n in classes])
        points, sides = learning._paths(leaves, tree)
        codes = ["".join(str(b) for b in row[::-1] if b >= 0) for row in sides]
        assert len(set(codes)) == len(codes) or len(codes) == 1
        assert not any(a != b and b.startswith(a) for a in codes for b in codes)
        heap, cost = sorted(weights.tolist()), 0
        while len(heap) > 1:
            both = heap.pop(0) + heap.pop(0)
            cost += both
            heap = sorted([*heap, both])
        assert sum(w * len(c) for w, c in zip(weights.tolist(), codes)) == cost


@pytest.mark.parametrize("words", [4_000, 400_000])
def test_word_vectors_tell_topics_apart(spark, monkeypatch, words):
    monkeypatch.setattr(learning, "BLOCK_WORDS", words)
    rng = np.random.default_rng(2)
    topics = [[f"{t}{i}" for i in range(12)] for t in "ab"]
    texts = [([str(w) for w in rng.choice(topics[i % 2], 40)],) for i in range(600)] + [(["alone"],), ([],), (None,)]
    out = learning.word_vectors(spark.createDataFrame(texts, "tokens array<string>").coalesce(1), "tokens", 8, rate=0.1, seed=1)
    got = {r["word"]: np.array(r["vector"]) for r in out.collect()}
    assert set(got) == {*topics[0], *topics[1], "alone"} and all(len(v) == 8 for v in got.values())
    unit = {w: v / np.linalg.norm(v) for w, v in got.items()}
    near = np.mean([unit[a] @ unit[b] for t in topics for a in t for b in t if a != b])
    far = np.mean([unit[a] @ unit[b] for a in topics[0] for b in topics[1]])
    assert near > far + 0.3
