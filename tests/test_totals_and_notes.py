"""Totals over cells, and notes of any length."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from statistics import mean, median

import pytest
from pyspark.sql import functions as F

from marlstone.operators import charts, ordered, pivots

START = datetime(2020, 1, 1)


def totals_by_hand(cells, fn, name):
    """``cells``: {(a, b, x, y): value}, rows a, b and columns x, y."""
    out = {k: v for k, v in cells.items()}
    for level in (1, 0):
        groups = defaultdict(list)
        for (a, b, x, y), v in cells.items():
            groups[a, b, *((x, "Subtotal") if level else (f"Total ({name})", ""))].append(v)
        out |= {k: fn(v) for k, v in groups.items()}
    whole = dict(out)
    for level in (1, 0):
        groups = defaultdict(list)
        for (a, b, x, y), v in out.items():
            groups[*((a, "Subtotal") if level else (f"Total ({name})", "")), x, y].append(v)
        whole |= {k: fn(v) for k, v in groups.items()}
    return whole


@pytest.mark.parametrize("name,fn,total", [("Average", mean, F.avg), ("Median", median, F.median), ("Maximum", max, F.max), ("Sum", sum, F.sum)])
def test_totals_over_cells(spark, name, fn, total):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice("pqr"), rng.choice("xy"), rng.choice("uv"), float(rng.randint(1, 50))) for _ in range(60)]
    cells = defaultdict(list)
    for *k, v in rows:
        cells[tuple(k)].append(v)
    df = spark.createDataFrame(rows, "a string, b string, x string, y string, v double")
    out = pivots.cell_subtotals(df, ["a", "b"], ["x", "y"], {"m": F.avg("v")}, total, name).collect()
    got = {tuple(r)[:4]: r["m"] for r in out}
    want = totals_by_hand({k: mean(v) for k, v in cells.items()}, fn, name)
    assert len(out) == len(got) == len(want)
    assert got == pytest.approx(want)


def test_totals_over_cells_differ_from_totals_over_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 5.0), (None, 9.0)], "k string, v double")
    of_cells = {r["k"]: r["v"] for r in pivots.cell_subtotals(df, ["k"], [], {"v": F.avg("v")}).collect()}
    of_rows = {r["k"]: r["v"] for r in pivots.subtotals(df, ["k"], [], {"v": F.avg("v")}, "Average").collect()}
    assert of_cells["Total (Average)"] == 5.0 and of_rows["Total (Average)"] == pytest.approx(17 / 5)
    assert {k: v for k, v in of_cells.items() if "Total" not in k} == {k: v for k, v in of_rows.items() if "Total" not in k}


def test_slices_make_up_the_interval(spark):
    rng = random.Random(4)
    ends = [(a, a + rng.choice([0, 1, 2, 5, 100, 10**6])) for a in (rng.randint(-1000, 10**6) for _ in range(60))] + [(-8, 7), (0, 0), (5, 4)]
    df = spark.createDataFrame(ends, "a bigint, b bigint").select("a", "b", charts.dyadic_slices(F.col("a"), F.col("b")).alias("s"))
    for r in df.collect():
        parts = sorted((x["place"] << x["level"], (x["place"] + 1) << x["level"]) for x in r["s"])
        at = r["a"]
        for low, high in parts:
            assert low == at
            at = high
        assert at == (r["b"] + 1 if parts else at) and bool(parts) == (r["b"] >= r["a"])
        assert len(parts) <= 2 * max(1, (r["b"] - r["a"] + 1).bit_length())


def test_a_long_note_is_a_few_slices(spark):
    notes = spark.createDataFrame([(START, START + timedelta(days=3653), "ten years")], "start_dttm timestamp_ntz, end_dttm timestamp_ntz, short_descr string")
    hours = lambda c: F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / 3600)
    assert len(notes.select(charts.dyadic_slices(hours("start_dttm"), hours("end_dttm")).alias("s")).first()["s"]) < 40


@pytest.mark.parametrize("width", ["second", "hour", "day", "week"])
def test_rows_meet_their_notes(spark, width):
    rng = random.Random(5)
    notes = []
    for k in range(40):
        begin = START + timedelta(seconds=rng.randint(0, 10**7))
        end = rng.choice([None, begin, begin - timedelta(hours=1), begin + timedelta(microseconds=3), begin + timedelta(seconds=rng.randint(1, 10**6)), begin + timedelta(days=4000)])
        notes.append((begin, end, f"n{k}"))
    times = [(i, START + timedelta(seconds=rng.randint(-1000, 2 * 10**7), microseconds=rng.randint(0, 5))) for i in range(300)]
    times += [(1000 + i, b) for i, (b, _, _) in enumerate(notes)] + [(2000 + i, e) for i, (_, e, _) in enumerate(notes) if e] + [(5000, None)]
    got = charts.interval_annotations(
        spark.createDataFrame(times, "id int, t timestamp_ntz"), "t", spark.createDataFrame(notes, "start_dttm timestamp_ntz, end_dttm timestamp_ntz, short_descr string"), width
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = sorted((i, n) for i, t in times for b, e, n in notes if t and b <= t <= (e or b))
    assert sorted((r["id"], r["short_descr"]) for r in got.collect()) == want and len(want) > 300


def test_notes_without_rows(spark):
    notes = spark.createDataFrame([], "start_dttm timestamp_ntz, end_dttm timestamp_ntz, short_descr string")
    assert charts.interval_annotations(spark.createDataFrame([(START,)], "t timestamp_ntz"), "t", notes, "hour").count() == 0
    with pytest.raises(ValueError, match="unknown width"):
        charts.interval_annotations(notes, "start_dttm", notes, "fortnight")


@pytest.mark.parametrize("chunk_rows", [1_000_000, 50])
def test_totals_of_the_rows_within_notes(spark, monkeypatch, chunk_rows):
    """Totals per note without pairs: ends that fall on rows, between rows, on one another; notes that come twice."""
    monkeypatch.setattr(ordered, "CHUNK_ROWS", chunk_rows)
    rng = random.Random(9)
    times = [(i, START + timedelta(seconds=rng.randint(0, 5000), microseconds=rng.randint(0, 3))) for i in range(200)] + [(900, None)]
    moments = [t for _, t in times if t] + [START + timedelta(seconds=k) for k in (-9, 777, 6000)]
    notes = [(rng.choice(moments), rng.choice([*moments, None]), rng.choice([None, "a", "b", "c", f"n{k}"])) for k in range(60)]
    notes += notes[:7] + [(None, moments[0], "none")]
    got = charts.interval_annotations(
        spark.createDataFrame(times, "id int, t timestamp_ntz"), "t",
        spark.createDataFrame(notes, "start_dttm timestamp_ntz, end_dttm timestamp_ntz, short_descr string"), "minute",
        totals={"n": ("count", None), "ids": ("sum", "id"), "low": ("min", "id"), "high": ("max", "id")},
    )
    want = defaultdict(list)
    for b, e, n in notes:
        want[n] += [i for i, t in times if t and b and b <= t <= (e or b)]
    assert {r["short_descr"]: tuple(r)[1:] for r in got.collect()} == {n: (len(v), sum(v), min(v), max(v)) for n, v in want.items() if v}


def test_totals_of_no_notes(spark):
    notes = spark.createDataFrame([], "start_dttm timestamp_ntz, end_dttm timestamp_ntz, short_descr string")
    assert charts.interval_annotations(spark.createDataFrame([(START,)], "t timestamp_ntz"), "t", notes, "hour", totals={"n": ("count", None)}).count() == 0
