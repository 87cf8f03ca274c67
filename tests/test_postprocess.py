from __future__ import annotations

import math

import pytest
from fixtures import column, day, shops, stock, timeseries, visits
from pyspark.sql import functions as F

from marlstone.functions import geohash as geo
from marlstone.operators import postprocess as pp
from marlstone.operators.forecast import forecast
from marlstone.operators.pivots import pivot


@pytest.mark.parametrize("row_level", [False, True])
def test_rolling(spark, row_level):
    ts = timeseries(spark)

    def run(kind, window, **options):
        out = pp.rolling(ts, kind, {"y": "r"}, window, "ts", min_periods=0, row_level=row_level, **options)
        return column(out, "r", "ts")

    assert run("sum", 2) == [4.0, 5.0, 7.0, 8.0]
    assert run("mean", 10) == pytest.approx([4, 5 / 2, 11 / 3, 13 / 4])
    assert run("count", 10) == [1.0, 2.0, 3.0, 4.0]
    assert run("quantile", 10, rolling_type_options={"quantile": 0.25}) == [4.0, 1.75, 2.5, 1.75]


def test_rolling_cuts_the_first_rows(spark):
    out = pp.rolling(timeseries(spark), "sum", {"y": "y"}, 2, "ts", min_periods=2)
    assert column(out, "y", "ts") == [5.0, 7.0, 8.0]


def test_rolling_shapes_match_pandas(spark):
    import pandas as pd

    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    series = pd.Series(values)
    for kind in ("skew", "kurt", "std", "var", "median"):
        got = column(pp.rolling(df, kind, {"v": "r"}, 5, "i", min_periods=5), "r", "i")
        want = [x for x in getattr(series.rolling(5), kind)().tolist() if not math.isnan(x)]
        assert got == pytest.approx(want)
    got = column(pp.rolling(df, "mean", {"v": "r"}, 3, "i", min_periods=1, center=True), "r", "i")
    assert got == pytest.approx(series.rolling(3, min_periods=1, center=True).mean().tolist())


def test_rolling_errors(spark):
    ts = timeseries(spark)
    for bad in (
        lambda: pp.rolling(ts, "sum", {"nope": "r"}, 2, "ts"),
        lambda: pp.rolling(ts, "abc", {"y": "r"}, 2, "ts"),
        lambda: pp.rolling(ts, "sum", {"y": "r"}, 0, "ts"),
        lambda: pp.rolling(ts, "sum", {"y": "r"}, 2, ()),
    ):
        with pytest.raises(pp.OperatorError):
            bad()


def test_cum(spark):
    ts = timeseries(spark)

    def run(df, op, dst="y2"):
        return column(pp.cum(df, op, {"y": dst}, "ts"), dst, "ts")

    assert run(ts, "sum") == [4, 5, 11, 13]
    assert run(ts, "prod") == [4, 4, 24, 48]
    assert run(ts, "min") == [4, 1, 1, 1]
    gap = timeseries(spark, (4.0, 1.0, None, 2.0))
    out = pp.cum(gap, "sum", {"y": "y2"}, "ts")
    assert column(out, "y2", "ts") == [4, 5, 5, 7] and column(out, "y", "ts") == [4, 1, None, 2]
    with pytest.raises(pp.OperatorError):
        pp.cum(ts, "abc", {"y": "y"}, "ts")


@pytest.mark.parametrize("row_level", [False, True])
def test_diff(spark, row_level):
    ts = timeseries(spark)
    assert column(pp.diff(ts, {"y": "d"}, 1, order="ts", row_level=row_level), "d", "ts") == [None, -3, 5, -4]
    assert column(pp.diff(ts, {"y": "d"}, -1, order="ts", row_level=row_level), "d", "ts") == [3, -5, 4, None]


def test_diff_over_columns(spark):
    ts = timeseries(spark, (5.0, 5.0, 5.0, 5.0), (5.0, 8.0, 1.0, 6.0))
    assert column(pp.diff(ts, {"y": "y1", "z": "z1"}, axis="column"), "z1", "ts") == [0, 3, -4, 1]


def test_compare(spark):
    ts = timeseries(spark, (5.0, 5.0, 5.0, 5.0), (5.0, 8.0, 1.0, 6.0))
    assert column(pp.compare(ts, ["y"], ["z"], "difference"), "difference__y__z", "ts") == [0, -3, 4, -1]
    out = pp.compare(ts, ["y"], ["z"], "percentage", drop_original_columns=True)
    assert out.columns == ["ts", "label", "percentage__y__z"]
    assert column(out, "percentage__y__z", "ts") == pytest.approx([0, -3 / 8, 4, -1 / 6], abs=1e-4)
    assert column(pp.compare(ts, ["y"], ["z"], "ratio"), "ratio__y__z", "ts") == pytest.approx([1, 5 / 8, 5, 5 / 6], abs=1e-4)
    with pytest.raises(pp.OperatorError):
        pp.compare(ts, ["y"], [], "ratio")


def test_resample(spark):
    rows = [("2021-03-01", 2.0, "a"), ("2021-03-04", 8.0, "b"), ("2021-03-06", 4.0, "c")]
    df = spark.createDataFrame([(day(d), y, s) for d, y, s in rows], "ts timestamp_ntz, y double, label string")
    out = pp.resample(df, "ts", "1D", "linear")
    assert column(out, "y", "ts") == [2, 4, 6, 8, 6, 4]
    assert column(out, "label", "ts") == ["a", None, None, "b", None, "c"]
    ts = timeseries(spark)
    assert column(pp.resample(ts, "ts", "1D", "ffill"), "y", "ts") == [4, 1, 1, 6, 6, 6, 6, 2]
    assert column(pp.resample(ts, "ts", "1D", "bfill"), "y", "ts") == [4, 1, 6, 6, 2, 2, 2, 2]
    assert column(pp.resample(ts, "ts", "1D", "asfreq", fill_value=0), "y", "ts") == [4, 1, 0, 6, 0, 0, 0, 2]
    assert column(pp.resample(ts, "ts", "1D", "sum", columns=["y"]), "y", "ts") == [4, 1, 0, 6, 0, 0, 0, 2]


def test_contribution(spark):
    rows = [("2021-03-01T08:00:00", 2.0, 6.0), ("2021-03-01T09:00:00", 6.0, 6.0), ("2021-03-01T10:00:00", None, None)]
    df = spark.createDataFrame([(day(t), a, b, None) for t, a, b in rows], "ts timestamp_ntz, a double, b double, c double")
    row = pp.contribution(df, "row")
    assert column(row, "a", "ts") == [0.25, 0.5, None]
    assert column(row, "b", "ts") == [0.75, 0.5, None]
    assert column(row, "c", "ts") == [None, None, None]
    whole = pp.contribution(df, "column")
    assert column(whole, "a", "ts") == [0.25, 0.75, 0]
    assert column(whole, "b", "ts") == [0.5, 0.5, 0]
    assert column(whole, "c", "ts") == [None, None, None]
    renamed = pp.contribution(df, "column", ["a"], rename_columns=["pct"])
    assert renamed.columns == ["ts", "a", "b", "c", "pct"]
    shifted = df.select("ts", "a", "b", F.col("a").alias("a__1 week ago"), F.col("b").alias("b__1 week ago"))
    out = pp.contribution(shifted, "row", time_shifts=["1 week ago"])
    assert column(out, "a__1 week ago", "ts") == [0.25, 0.5, None] and column(out, "a", "ts") == [0.25, 0.5, None]


def test_aggregate(spark):
    aggregates = {
        "sum": {"column": "up", "operator": "sum"},
        "upper": {"column": "up", "operator": "percentile", "options": {"q": 75}},
        "lower": {"column": "down", "operator": "percentile", "options": {"q": 25}},
    }
    row = pp.aggregate(stock(spark), ["whole"], aggregates).first()
    assert (row["sum"], row["upper"], row["lower"]) == (1560, 58.5, 21.5)
    empty = pp.aggregate(stock(spark), [], {"n": {"column": "sparse", "operator": "median"}}).collect()
    assert len(empty) == 1 and empty[0]["n"] is None
    for bad in ("cumsum", "abc"):
        with pytest.raises(pp.OperatorError):
            pp.aggregate(stock(spark), ["whole"], {"x": {"column": "up", "operator": bad}})


def test_boxplot(spark):
    out = pp.boxplot(shops(spark), ["area"], ["sales"])
    assert sorted(out.columns) == sorted(
        ["area"] + [f"sales__{s}" for s in ("mean", "median", "max", "min", "q1", "q3", "count", "outliers")]
    )
    assert out.count() == 3  # rows without an area are dropped
    north = out.filter("area = 'north'").first()
    assert (north["sales__min"], north["sales__max"], north["sales__count"], north["sales__outliers"]) == (10, 18, 5, [])
    with pytest.raises(pp.OperatorError):
        pp.boxplot(shops(spark), ["area"], ["sales"], "percentile", (90, 10))
    with pytest.raises(pp.OperatorError):
        pp.boxplot(shops(spark), ["area"], ["sales"], "abc")


def test_boxplot_lists_outliers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 5, 100, -50)], "g string, v double")
    row = pp.boxplot(df, ["g"], ["v"]).first()
    assert row["v__outliers"] == [100.0, -50.0]
    assert sorted(r["v"] for r in pp.boxplot_outliers(df, ["g"], "v").collect()) == [-50.0, 100.0]


def test_pivot(spark):
    spec = {"sparse": {"operator": "sum"}}
    df = stock(spark)
    out = pivot(df, ["item"], spec)
    assert out.count() == 40 and out.agg(F.sum("sparse")).first()[0] == 80
    out = pivot(df, ["item"], spec, ["kind"])
    assert out.columns == ["item", "sparse, g0", "sparse, g1", "sparse, g2"]
    assert out.agg(F.sum("`sparse, g0`")).first()[0] == 24
    filled = pivot(df, ["item"], spec, ["kind"], metric_fill_value=1)
    assert filled.agg(F.sum("`sparse, g0`")).first()[0] == 24 + 26  # the items of other kinds
    assert len(pivot(df, ["item"], spec, ["kind", "shelf"]).columns) == 16
    combined = pivot(df, ["item"], spec, ["kind"], combine_value_with_metric=True)
    assert combined.columns[1] == "g0, sparse"
    for bad in (lambda: pivot(df, [], spec), lambda: pivot(df, ["item"], {}), lambda: pivot(df, ["nope"], spec)):
        with pytest.raises(pp.OperatorError):
            bad()


def test_pivot_keeps_null_columns_under_their_label(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2)], "i string, c string, v int")
    assert pivot(df, ["i"], {"v": {"operator": "sum"}}, ["c"]).first().asDict() == {"i": "a", "v, <NULL>": 1, "v, x": 2}


def test_pivot_then_rolling_equals_long_then_pivot(spark):
    """The chain in long form gives the wide frame's cells."""
    long = pp.rolling(visits(spark), "sum", {"visits": "visits"}, 2, "day", ["land"], min_periods=0)
    wide = pivot(long, ["day"], {"visits": {"operator": "sum"}}, ["land"])
    assert [tuple(r)[1:] for r in wide.orderBy("day").collect()] == [(2.0, 7.0), (5.0, 8.0)]


def test_select_rename_sort(spark):
    ts = timeseries(spark)
    assert pp.select(ts, ["label"], rename={"label": "l"}).columns == ["l"]
    assert pp.select(ts, exclude=["label"]).columns == ["ts", "y"]
    assert pp.rename(ts, {"label": "l"}).columns == ["ts", "l", "y"]
    with pytest.raises(pp.OperatorError):
        pp.rename(ts, {"label": "y"})
    gap = timeseries(spark, (1.0, 2.0, None, 4.0))
    assert [r["y"] for r in pp.sort(gap, "y", False).collect()] == [4.0, 2.0, 1.0, None]
    assert pp.flatten(ts, {"y": ["a, b", None, "c"]}).columns[-1] == "a\\, b, c"


def geohash_of(lat, lon, size=12):
    """Halves of the map in turns, five to a letter."""
    bounds, out, bits = [[-180.0, 180.0], [-90.0, 90.0]], "", 0
    for k in range(5 * size):
        own, value = bounds[k % 2], (lon, lat)[k % 2]
        middle = sum(own) / 2
        bits = bits << 1 | (value >= middle)
        own[value < middle] = middle
        if k % 5 == 4:
            out, bits = out + "0123456789bcdefghjkmnpqrstuvwxyz"[bits], 0
    return out


def test_points(spark):
    places = [(59.91273, 10.74609, "2.5km", 2.5), (-12.04637, -77.04279, "154m", 0.154)]
    rows = [(geohash_of(lat, lon), lat, lon, f"{lat}, {lon}, {above}", high) for lat, lon, above, high in places]
    df = spark.createDataFrame(rows, "h string, lat double, lon double, text string, alt double")
    for r in pp.geohash_encode(df, "out", "lon", "lat").collect():
        assert r["out"] == r["h"]
    for r in pp.geohash_decode(df, "h", "x", "y").collect():
        assert (r["y"], r["x"]) == pytest.approx((r["lat"], r["lon"]), abs=1e-6)
    for r in pp.geodetic_parse(df, "text", "x", "y", "a").collect():
        assert (r["y"], r["x"], r["a"]) == pytest.approx((r["lat"], r["lon"], r["alt"]))
    bad = spark.createDataFrame([("ail",)], "h string")
    assert bad.select(geo.decode(F.col("h"), strict=False).alias("p")).first()["p"] is None
    with pytest.raises(Exception, match="not a geohash"):
        bad.select(geo.decode(F.col("h"))).collect()


def test_forecast_of_a_line_is_exact(spark):
    rows = [(day(f"2020-01-{d:02d}"), 3.0 + 2 * d, k) for d in range(1, 29) for k in ("a", "b")]
    df = spark.createDataFrame(rows, "__timestamp timestamp_ntz, y double, k string")
    out = forecast(df, "P1D", 5, 0.9, keys=["k"], columns=["y"])
    assert out.count() == 2 * (28 + 5)
    last = out.filter("k = 'a'").orderBy(F.desc("__timestamp")).first()
    assert last["y"] is None and last["y__yhat"] == pytest.approx(3.0 + 2 * 33, abs=1e-6)
    assert out.filter("y__yhat_lower > y__yhat or y__yhat > y__yhat_upper").count() == 0
    single = forecast(df.filter("k = 'a'").drop("k"), "P1D", 3, 0.9)
    assert single.count() == 31
    for bad in (
        lambda: forecast(df, "P1D", 3, 1.5), lambda: forecast(df, "P1D", -1, 0.5), lambda: forecast(df, "nope", 3, 0.5),
        lambda: forecast(df.select("k", "__timestamp"), "P1D", 3, 0.5, keys=["k"]),
    ):
        with pytest.raises(pp.OperatorError):
            bad()


def test_densify(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (2, "b", 5)], "t int, k string, v int")
    out = pp.densify(df, "t", ["k"])
    assert sorted((r["k"], r["t"], r["v"]) for r in out.collect() if r["v"]) == [("a", 1, 1), ("a", 2, 2), ("b", 2, 5)]
    assert out.count() == 4


def test_a_value_named_like_the_margin_keeps_its_own_cell(spark):
    from marlstone.operators.pivots import pivot

    df = spark.createDataFrame([("a", "All", 1), ("a", "B", 2), ("All", "B", 4)], "i string, c string, v long")
    out = pivot(df, ["i"], {"v": {"operator": "sum"}}, ["c"], marginal_distributions=True)
    rows = sorted((tuple(r) for r in out.collect()), key=repr)
    assert out.columns == ["i", "v, All", "v, All__1", "v, B"]
    assert rows == sorted([("a", 1, 3, 2), ("All", None, 4, 4), ("All", 1, 7, 6)], key=repr)
