"""Words of a block are looked up at once, nulls among them are no words."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow.compute as pc

from marlstone.operators import learning


def test_one_lookup_a_block(spark, monkeypatch):
    lookups = spark.sparkContext.accumulator(0)
    plain = pc.index_in

    def counting(*args):
        lookups.add(1)
        return plain(*args)

    monkeypatch.setattr(learning, "pc", SimpleNamespace(index_in=counting, fill_null=pc.fill_null, list_value_length=pc.list_value_length))
    texts = [([f"w{k % 37}", f"w{k % 5}", f"w{k}"],) for k in range(300)]
    out = learning.word_vectors(spark.createDataFrame(texts, "tokens array<string>").coalesce(1), "tokens", 4)
    assert out.count() == 300 and lookups.value == 1


def test_null_words_and_texts(spark):
    texts = [([None, "b", "a"],), (["a", None],), (None,), ([],), (["b", "c", "a"],), ([None],), (["b", "a"],)]
    plain = [(["b", "a"],), (["a"],), (["b", "c", "a"],), (["b", "a"],)]
    got, want = ({r["word"]: r["vector"] for r in learning.word_vectors(spark.createDataFrame(t, "tokens array<string>").coalesce(1), "tokens", 4).collect()} for t in (texts, plain))
    assert set(got) == {"a", "b", "c"} and got == want


def test_a_step_equals_its_pairs_one_by_one():
    """One step from fixed beginnings against sums over single pairs of words."""
    rng = np.random.default_rng(5)
    _, tree = learning.huffman_runs([(n, 1) for n in range(1, 12)])
    points, sides = learning._paths(np.arange(11), tree)
    sentences = [rng.integers(0, 11, n) for n in (6, 1, 8)]
    begin = rng.normal(size=(11, 3)).astype(np.float32)
    got = learning._trained(sentences, begin.copy(), points, sides, 3, 0.5, np.random.default_rng(9))
    words, of = np.concatenate(sentences), np.repeat(np.arange(3), [6, 1, 8])
    reach = np.random.default_rng(9).integers(1, 4, len(words))
    vectors, above = begin.astype(float), np.zeros((points.max() + 1, 3))
    want = vectors.copy()
    # Weights begin at zero, so in the first step of 15 words every pair pulls by half the rate and vectors stay.
    for i, w in enumerate(words):
        for j, v in enumerate(words):
            if i != j and abs(i - j) <= reach[i] and of[i] == of[j]:
                for p, s in zip(points[w], sides[w]):
                    if s >= 0:
                        above[p] += (1 - s - 0.5) * 0.5 * vectors[v]
    assert np.allclose(got, want, atol=1e-6) and np.abs(above).max() > 0
    # With the sentences twice the second step, from these weights, moves the vectors.
    twice = learning._trained([*sentences, np.zeros(1, int), *sentences], begin.copy(), points, sides, 3, 0.5, np.random.default_rng(9))
    assert np.abs(twice - begin).max() > 1e-3
