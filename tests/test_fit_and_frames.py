"""Goodness of fit against exact values, and vectorised functions over frames."""

from __future__ import annotations

import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import learning, userfunctions


def tail(x, k):
    """Chi-square tail for whole degrees of freedom, by the closed sums."""
    half = x / 2
    if k % 2 == 0:
        return math.exp(-half) * sum(half**j / math.factorial(j) for j in range(k // 2))
    out, term = math.erfc(math.sqrt(half)), math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for j in range(1, (k - 1) // 2 + 1):
        out, term = out + term, term * half / (j + 0.5)
    return out


def test_tail_of_chi_square(spark):
    cases = [(x, k) for k in (1, 2, 3, 4, 5, 8, 11, 30, 101) for x in (0.0, 0.01, 0.5, 1.0, 2.0, k - 0.5, k + 0.5, 3.0 * k, 150.0)]
    df = spark.createDataFrame(cases, "x double, k int").select("x", "k", learning.chi_square_tail(F.col("x"), F.col("k")).alias("p"))
    for r in df.collect():
        assert r["p"] == pytest.approx(tail(r["x"], r["k"]), rel=1e-9, abs=1e-14), r
    assert spark.range(1).select(learning.chi_square_tail(F.lit(1.0), F.lit(0))).first()[0] is None


def test_fit_of_counts(spark):
    df = spark.createDataFrame([(v,) for v, n in (("a", 30), ("b", 50), (None, 20)) for _ in range(n)], "v string")
    even = learning.chi_square_fit(df, "v").first()
    want = sum((n - 100 / 3) ** 2 / (100 / 3) for n in (30, 50, 20))
    assert (even["statistic"], even["freedom"], even["p_value"]) == (pytest.approx(want), 2, pytest.approx(tail(want, 2)))
    shares = spark.createDataFrame([("a", 3.0), ("b", 5.0), (None, 1.0), ("c", 1.0)], "value string, share double")
    given = learning.chi_square_fit(df, "v", shares).first()
    want = sum((n - e) ** 2 / e for n, e in ((30, 30), (50, 50), (20, 10), (0, 10)))
    assert (given["statistic"], given["freedom"]) == (pytest.approx(want), 3)
    odd = learning.chi_square_fit(df, "v", shares.where("value = 'a'")).first()
    assert (odd["statistic"], odd["p_value"]) == (math.inf, 0.0)
    assert learning.chi_square_fit(df.where("false"), "v").count() == 0


def test_distance_from_a_normal_distribution(spark):
    rng = random.Random(1)
    values = [rng.gauss(3, 2) for _ in range(500)] + [3.0] * 20 + [40.0, -40.0]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(4)
    row = learning.kolmogorov_distance(df, "v", lambda v: learning.normal_share(v, F.lit(3.0), F.lit(2.0))).first()
    ordered, n, law = sorted(values), len(values), NormalDist(3, 2)
    want = max(max((i + 1) / n - law.cdf(v), law.cdf(v) - i / n) for i, v in enumerate(ordered))
    assert (row["statistic"], row["n"]) == (pytest.approx(want, abs=1e-12), n)
    lam = want * math.sqrt(n)
    assert row["p_value"] == pytest.approx(2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 101)))


@pytest.mark.parametrize("block_rows", [3, 7, 1000])
def test_functions_over_frames(spark, block_rows):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.choice([None, *map(float, range(9))]), "x") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, v double, note string").repartition(5)

    def total(frames):
        return np.nansum(frames, axis=1)

    got = {r["i"]: r for r in userfunctions.window_function(df, ["k"], [("i", True)], "v", "s", total, 3, 1, block_rows).collect()}
    assert len(got) == len(rows)
    for k, i, v, note in rows:
        own = [r for r in rows if r[0] == k]
        at = next(p for p, r in enumerate(own) if r[1] == i)
        assert got[i]["s"] == sum(r[2] or 0 for r in own[max(0, at - 3) : at + 2])
        assert (got[i]["k"], got[i]["v"], got[i]["note"]) == (k, v, note)


def test_frames_without_a_number_are_null(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0)], "i int, v double")

    def mean(frames):
        return np.array([np.nan if np.isnan(f).all() else np.nanmean(f) for f in frames])

    assert [r["m"] for r in userfunctions.window_function(df, [], [("i", True)], "v", "m", mean, 1).sort("i").collect()] == [None, 4.0]
    with pytest.raises(ValueError, match="its own row"):
        userfunctions.window_function(df, [], [("i", True)], "v", "m", mean, -1)
