"""Comparison with earlier periods."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grains import WEEK_STARTING_SUNDAY, bucket, offset_key, shift
from ..operators import comparison as cmp
from ..plans import builder
from ..plans.request import Dim, Metric, Request
from .registry import Tables, query
from .requests import NOW, orders, rounded

TOTAL = Metric("total", "SUM", "o_totalprice")

_OFFSETS = """
    WITH q AS (SELECT date_trunc('quarter', o_orderdate)::TIMESTAMP AS quarter, o_orderstatus, sum(o_totalprice) AS total
               FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2001-07-01' GROUP BY 1, 2),
    y AS (SELECT date_trunc('quarter', o_orderdate)::TIMESTAMP AS quarter, o_orderstatus, sum(o_totalprice) AS total
               FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-07-01' GROUP BY 1, 2)
"""


def _with_offset(t: Tables) -> DataFrame:
    request = Request(
        columns=[Dim("quarter", "o_orderdate", "P3M"), "o_orderstatus"],
        metrics=[TOTAL],
        time_range="1997-01-01 : 2001-07-01",
        time_offsets=["1 year ago"],
    )
    return builder.compile_request(orders(t), request, NOW)


@query(
    "time_offset_join",
    _OFFSETS
    + """
    SELECT q.quarter, q.o_orderstatus, round(q.total, 2) AS total, round(y.total, 2) AS "total__1 year ago"
    FROM q LEFT JOIN y ON y.quarter = q.quarter - INTERVAL 1 YEAR AND y.o_orderstatus = q.o_orderstatus
    """,
)
def time_offset_join(t: Tables) -> DataFrame:
    return rounded(_with_offset(t), 2)


@query(
    "time_offset_two",
    """
    WITH d AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2),
    q AS (SELECT * FROM d WHERE day >= TIMESTAMP '2024-01-10' AND day < TIMESTAMP '2024-01-30')
    SELECT q.day, q.event_type, q.n, a.n AS "n__1 day ago", b.n AS "n__1 week ago"
    FROM q LEFT JOIN d a ON a.day = q.day - INTERVAL 1 DAY AND a.event_type = q.event_type
      LEFT JOIN d b ON b.day = q.day - INTERVAL 7 DAY AND b.event_type = q.event_type
    """,
)
def time_offset_two(t: Tables) -> DataFrame:
    from ..plans.request import Dataset

    request = Request(
        columns=[Dim("day", "ts", "P1D"), "event_type"],
        metrics=[Metric("n", "COUNT", "*")],
        time_range="2024-01-10 : 2024-01-30",
        time_offsets=["1 day ago", "1 week ago"],
    )
    return builder.compile_request(Dataset(t("events"), time_column="ts"), request, NOW)


@query(
    "offset_bucket_key",
    """
    SELECT o_orderkey, strftime(o_orderdate - INTERVAL 7 DAY, '%Y-W%W') AS week_monday,
      strftime(o_orderdate - INTERVAL 7 DAY, '%Y-W%U') AS week_sunday, strftime(o_orderdate, '%Y-%m') AS month,
      year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter, strftime(o_orderdate, '%Y') AS year
    FROM orders
    """,
)
def offset_bucket_key(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    moved = shift(d, "-7 days")
    return t("orders").select(
        "o_orderkey",
        offset_key(d, "P1W", moved).alias("week_monday"),
        offset_key(d, WEEK_STARTING_SUNDAY, moved).alias("week_sunday"),
        offset_key(d, "P1M").alias("month"),
        offset_key(d, "P3M").alias("quarter"),
        offset_key(d, "P1Y").alias("year"),
    )


@query(
    "time_compare_series",
    _OFFSETS
    + """
    SELECT q.quarter, q.o_orderstatus, round((q.total - y.total) / y.total, 4) AS "percentage__total__total__1 year ago"
    FROM q LEFT JOIN y ON y.quarter = q.quarter - INTERVAL 1 YEAR AND y.o_orderstatus = q.o_orderstatus
    """,
)
def time_compare_series(t: Tables) -> DataFrame:
    return cmp.compare_series(_with_offset(t), ["total"], "1 year ago", "percentage")


@query(
    "period_over_period",
    """
    WITH s AS (SELECT o_orderpriority,
        sum(o_totalprice) FILTER (WHERE o_orderdate >= TIMESTAMP '2000-01-01') AS a,
        sum(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '2000-01-01') AS b
      FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1)
    SELECT o_orderpriority, round(a, 2) AS total, round(b, 2) AS total_previous, round(a - b, 2) AS total_difference,
      round((a - b) / abs(b), 8) AS total_change FROM s
    """,
)
def period_over_period(t: Tables) -> DataFrame:
    out = cmp.period_over_period(
        t("orders"),
        "o_orderdate",
        {"total": F.col("o_totalprice")},
        (datetime(2000, 1, 1), datetime(2001, 1, 1)),
        (datetime(1999, 1, 1), datetime(2000, 1, 1)),
        ["o_orderpriority"],
    )
    return out.select(
        "o_orderpriority",
        *[F.round(c, 8 if c.endswith("change") else 2).alias(c) for c in out.columns[1:]],
    )


@query(
    "big_number_trend",
    """
    WITH m AS (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, sum(o_totalprice) AS v FROM orders GROUP BY 1),
    r AS (SELECT month, v, lag(v, 12) OVER (ORDER BY month) AS p FROM m)
    SELECT month, round(v, 2) AS value, round(p, 2) AS compare_value, round((v - p) / abs(p), 8) AS change
    FROM r ORDER BY month DESC LIMIT 1
    """,
)
def big_number_trend(t: Tables) -> DataFrame:
    m = t("orders").groupBy(bucket(F.col("o_orderdate"), "P1M").alias("month")).agg(F.sum("o_totalprice").alias("v"))
    out = cmp.big_number(m, "month", "v", 12)
    return out.select(
        "month", F.round("value", 2).alias("value"), F.round("compare_value", 2).alias("compare_value"), F.round("change", 8).alias("change")
    )


@query(
    "time_pivot",
    """
    SELECT date_trunc('year', o_orderdate)::TIMESTAMP AS period,
      date_diff('day', date_trunc('year', o_orderdate), o_orderdate)::INTEGER AS place, round(sum(o_totalprice), 2) AS value
    FROM orders GROUP BY 1, 2
    """,
)
def time_pivot(t: Tables) -> DataFrame:
    return rounded(cmp.time_pivot(t("orders"), "o_orderdate", F.col("o_totalprice"), "AS"), 2)


@query(
    "time_pivot_weeks",
    """
    WITH w AS (SELECT o_totalprice, o_orderdate, TIMESTAMP '1969-12-29' +
        INTERVAL 1 DAY * (28 * (date_diff('day', TIMESTAMP '1969-12-29', o_orderdate) // 28)) AS period FROM orders)
    SELECT period, date_diff('day', period, o_orderdate)::INTEGER AS place, round(sum(o_totalprice), 2) AS value
    FROM w GROUP BY 1, 2
    """,
)
def time_pivot_weeks(t: Tables) -> DataFrame:
    return rounded(cmp.time_pivot(t("orders"), "o_orderdate", F.col("o_totalprice"), "4W-MON"), 2)
