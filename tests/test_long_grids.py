"""Grids of any length, and values between far points."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from marlstone.operators import postprocess as pp

START = datetime(2021, 3, 1)


def filled(spark, rows, rule, method, keys=("k",)):
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    return pp.resample(df if keys else df.drop("k"), "t", rule, method, list(keys), ["v"])


@pytest.mark.parametrize("stretch", [4, 1 << 16])
@pytest.mark.parametrize("rule,step", [("1h", timedelta(hours=1)), ("90s", timedelta(seconds=90)), ("2D", timedelta(days=2))])
def test_linear_over_stretches(spark, monkeypatch, stretch, rule, step):
    monkeypatch.setattr(pp, "GRID_ROWS", stretch)
    known = {"a": {0: 3.0, 7: 17.0, 8: 1.0, 30: 12.0}, "b": {5: 2.0}, "c": {0: None, 30: 4.0}}
    rows = [(k, START + i * step, v) for k, points in known.items() for i, v in points.items()]
    got = {(r["k"], r["t"]): r["v"] for r in filled(spark, rows, rule, "linear").collect()}
    assert len(got) == 3 * 31
    for k, points in known.items():
        there = {i: v for i, v in points.items() if v is not None}
        for i in range(31):
            before, after = [x for x in there if x <= i], [x for x in there if x >= i]
            want = None if not before else there[max(before)] if not after else None
            if before and after:
                x, y = max(before), min(after)
                want = there[x] if x == y else there[x] + (there[y] - there[x]) * (i - x) / (y - x)
            assert got[k, START + i * step] == (None if want is None else pytest.approx(want)), (k, i)


def test_months_and_a_frame_without_keys(spark):
    rows = [("a", datetime(2021, 1, 1), 1.0), ("a", datetime(2021, 5, 1), 9.0)]
    assert [r["v"] for r in filled(spark, rows, "1MS", "linear", ()).sort("t").collect()] == [1, 3, 5, 7, 9]
    assert [r["t"].month for r in filled(spark, rows, "2MS", "asfreq", ()).sort("t").collect()] == [1, 3, 5]
    assert filled(spark, [], "1h", "linear").count() == 0


def test_a_long_grid_is_made_of_stretches(spark):
    rows = [("a", START, 1.0), ("a", START + timedelta(days=10), 2.0)]
    out = filled(spark, rows, "1s", "asfreq", ())
    assert out.count() == 10 * 86_400 + 1
    days = spark.range(1).selectExpr("timestamp_ntz'2021-03-01' AS lo", "timestamp_ntz'2021-03-11' AS hi")
    ends = pp.F.struct(pp.F.lit(START).cast("timestamp_ntz").alias("lo"), pp.F.lit(START + timedelta(days=10)).cast("timestamp_ntz").alias("hi"))
    grid = pp._grid(days.select(pp.F.lit("x").alias("k")), ["k"], ends, 1, "second", "t")
    assert grid.agg(pp.F.max("__i"), pp.F.countDistinct("t")).first()[:] == (864_000, 864_001)
