"""Chunked results equal plain windows, also when one key holds most rows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marlstone.operators import ordered
from marlstone.operators.ordered import Running, running, sliding
from marlstone.operators.quantiles import exact_quantiles

ORDER = [("t", True), ("id", True)]


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows under one key, nulls among keys, order values and values, many ties."""
    k = F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 11 != 0, F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    t = F.when(F.col("id") % 13 != 0, F.pmod(F.xxhash64("id"), F.lit(300)))
    v = F.when(F.col("id") % 5 != 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("double"))
    return spark.range(3000).select("id", k.alias("k"), t.alias("t"), v.alias("v")).cache()


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


@pytest.mark.parametrize("keys", [["k"], []])
def test_running(skewed, keys):
    specs = {
        "rn": Running("row_number"), "s": Running("sum", "v"), "c": Running("count", "v"), "lo": Running("min", "v"),
        "hi": Running("max", "v"), "tile": Running("ntile", n=7), "ff": Running("fill_forward", "v"), "first": Running("first_value", "v"),
    }
    chunked = running(skewed, keys, ORDER, specs, chunks=9)
    plain = running(skewed, keys, ORDER, specs, small=True)
    same(chunked, plain)


def test_ranks(skewed):
    specs = {k: Running(k) for k in ("rank", "dense_rank", "percent_rank", "cume_dist")}
    same(running(skewed, ["k"], [("t", True)], specs, chunks=9), running(skewed, ["k"], [("t", True)], specs, small=True))


def test_descending(skewed):
    order = [("v", False), ("id", True)]
    specs = {"rn": Running("row_number"), "s": Running("sum", "id")}
    same(running(skewed, ["k"], order, specs, chunks=9), running(skewed, ["k"], order, specs, small=True))


@pytest.mark.parametrize("block_rows", [10, 64])
def test_sliding(skewed, block_rows):
    make = {
        "mean": lambda w: F.round(F.avg("v").over(w.rowsBetween(-4, 3)), 9),
        "back": lambda w: F.lag("v", 5).over(w),
        "ahead": lambda w: F.lead("v", 2).over(w),
    }
    blocks = sliding(skewed, ["k"], ORDER, make, before=5, after=3, block_rows=block_rows, chunks=6)
    window = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), F.col("id").asc_nulls_first())
    plain = skewed.select("*", *[f(window).alias(n) for n, f in make.items()])
    same(blocks, plain)


def test_other_order_types(spark):
    df = spark.range(500).select(
        "id", F.concat(F.lit("n"), (F.col("id") * 37 % 101).cast("string")).alias("name"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"),
    )
    for lead in ("name", "d"):
        order = [(lead, True), ("id", True)]
        specs = {"rn": Running("row_number")}
        same(running(df, [], order, specs, chunks=8), running(df, [], order, specs, small=True))


@pytest.mark.parametrize("method", ["linear", "midpoint", "lower", "higher"])
def test_quantiles(skewed, method):
    wanted = {"a": 0.1, "b": 0.5, "c": 0.77}
    far = exact_quantiles(skewed, ["k"], "v", wanted, method, chunks=7)
    near = exact_quantiles(skewed, ["k"], "v", wanted, method, small=True)
    def rounded(df):
        return df.select("k", *[F.round(c, 9).alias(c) for c in wanted])

    same(rounded(far), rounded(near))


VALUES = {
    "integer": "CAST(pmod(xxhash64(id, 2), 50) AS int)",
    "decimal": "CAST(pmod(xxhash64(id, 3), 5000) / 100 AS decimal(12,2))",
    "double": "CAST(pmod(xxhash64(id, 4), 64) AS double) / 4",
    "text": "concat('Customer#0000', pmod(xxhash64(id, 5), 400))",
}


@pytest.mark.parametrize("up", [True, False])
@pytest.mark.parametrize("second_up", [True, False])
@pytest.mark.parametrize("kind", VALUES)
def test_every_result_in_every_direction(spark, kind, up, second_up):
    """Values, their types and the direction of the order: chunks give what plain windows give."""
    made = F.expr(VALUES[kind])
    df = spark.range(900).select("id", (F.col("id") % 3).alias("k"), F.when(F.col("id") % 5 != 0, made).alias("v"), made.alias("o"))
    kinds = ["row_number", "count", "min", "max", "fill_forward", "first_value", "rank", "dense_rank", "percent_rank", "cume_dist"]
    kinds += [] if kind == "text" else ["sum", "avg"]
    specs = {k: Running(k, None if "rank" in k or k in ("row_number", "cume_dist") else "v") for k in kinds} | {"ntile": Running("ntile", n=4)}
    order = [("o", up), ("id", second_up)]
    plain = running(df, ["k"], order, specs, small=True)
    for chunks in (None, 7):
        chunked = running(df, ["k"], order, specs, chunks=chunks).select(*plain.columns)
        assert [f.dataType for f in chunked.schema] == [f.dataType for f in plain.schema]
        same(chunked, plain)


def test_long_common_beginnings_spread_over_all_chunks(spark):
    df = spark.range(3000).select("id", F.format_string("Customer#%09d", "id").alias("name"))
    sizes = [r["count"] for r in ordered.with_chunks(df, [("name", True)], 16).groupBy(ordered.CHUNK).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3000 / 6


def test_chunks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 100)
    df = spark.range(1000).select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    for lead in ("id", "name"):
        assert ordered.with_chunks(df, [(lead, True)]).select(ordered.CHUNK).distinct().count() == 10


@pytest.mark.parametrize("up", [True, False])
@pytest.mark.parametrize("second_up", [True, False])
def test_one_order_value_holds_a_third(spark, up, second_up):
    t = F.when(F.col("id") % 3 == 0, F.lit(50)).when(F.col("id") % 17 != 0, F.col("id") % 100)
    df = spark.range(2000).select((F.col("id") % 2).alias("k"), t.alias("t"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("u"), "id")
    order = [("t", up), ("u", second_up), ("id", True)]
    specs = {"rn": Running("row_number"), "s": Running("sum", "id")}
    same(running(df, ["k"], order, specs, chunks=12), running(df, ["k"], order, specs, small=True))
    sizes = ordered.with_chunks(df, order, 12).groupBy(ordered.CHUNK).count().agg(F.max("count")).first()[0]
    assert sizes < 2000 / 4
    ranks = {"r": Running("rank"), "d": Running("dense_rank")}
    same(running(df, ["k"], [("t", up)], ranks, chunks=12), running(df, ["k"], [("t", up)], ranks, small=True))
