"""Plans that would hold on a large cluster."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from marlstone.catalogue import QUERIES, load
from marlstone.operators.charts import interval_annotations
from marlstone.plans.builder import compile_request
from marlstone.plans.request import Dataset, Dim, Filter, Metric, Request

from places import FOLDER

load()
NOW = datetime(2001, 12, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(tables):
    request = Request(
        columns=[Dim("month", "l_shipdate", "P1M")],
        metrics=[Metric("qty", "SUM", "l_quantity")],
        filters=[Filter("l_shipdate", "TEMPORAL_RANGE", "1996-01-01 : 1997-01-01"), Filter("l_returnflag", "IN", ["A", "R"])],
    )
    text = plan(compile_request(Dataset(tables("lineitem")), request, NOW))
    assert "GreaterThanOrEqual(l_shipdate" in text and "In(l_returnflag" in text
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_time_comparison_reads_only_its_ranges(spark):
    text = plan(QUERIES["time_offset_join"](spark, FOLDER))
    assert text.count("LessThan(o_orderdate") >= 2


def test_top_n_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["topn_group"](spark, FOLDER))


def test_no_cross_join_anywhere(spark):
    for name in (
        "contribution", "percent_metric", "histogram", "funnel", "heatmap_share", "resample_fill", "interval_annotations",
        "series_limit", "pivot_fractions", "break_points", "forecast", "stat_density",
    ):
        text = plan(QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_range_join_is_an_equi_join(spark, tables):
    notes = tables("events").limit(5).select(
        F.col("ts").alias("start_dttm"), F.timestamp_add("HOUR", F.lit(3), F.col("ts")).alias("end_dttm"), F.lit("x").alias("short_descr")
    )
    text = plan(interval_annotations(tables("events"), "ts", notes, "hour"))
    assert "NestedLoop" not in text


def test_totals_come_from_one_scan(spark):
    assert plan(QUERIES["totals_row"](spark, FOLDER)).count("FileScan") == 1
    assert plan(QUERIES["period_over_period"](spark, FOLDER)).count("FileScan") == 1
    assert plan(QUERIES["alert_operator"](spark, FOLDER)).count("FileScan") == 1


def test_grouping_combines_before_the_shuffle(spark):
    text = plan(QUERIES["aggregate_query"](spark, FOLDER))
    assert "partial_sum" in text and text.count("Exchange") == 1
