"""Alerts and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alerts
from ..session import scratch_path
from .registry import Tables, query


@query(
    "alert_operator",
    """
    WITH s AS (SELECT count(*)::DOUBLE AS n, round(avg(o_totalprice), 4) AS m, max(o_totalprice) AS x, 0.0::DOUBLE AS z FROM orders)
    SELECT 'many orders' AS rule, n AS value, n >= 1000 AS triggered FROM s
    UNION ALL SELECT 'low average', m, m < 1000 FROM s UNION ALL SELECT 'high price', x, x > 300000 FROM s
    UNION ALL SELECT 'no returns', z, z = 0 FROM s
    """,
)
def alert_operator(t: Tables) -> DataFrame:
    """Four rules over one table in one scan."""
    p = F.col("o_totalprice")
    rules = {
        "many orders": (F.count(F.lit(1)), ">=", 1000),
        "low average": (F.round(F.avg(p), 4), "<", 1000),
        "high price": (F.max(p), ">", 300000),
        "no returns": (F.sum(F.when(F.col("o_orderstatus") == "X", p)), "==", 0),
    }
    return alerts.run_rules(t("orders"), rules)


@query(
    "alert_not_null",
    """
    SELECT event_type, count(*) FILTER (WHERE value > 300)::BIGINT AS value, count(*) FILTER (WHERE value > 300) > 0 AS triggered
    FROM events GROUP BY 1
    """,
)
def alert_not_null(t: Tables) -> DataFrame:
    """One check per event type: fires when the value is neither 0 nor null."""
    value = F.count_if(F.col("value") > 300)
    checked = t("events").groupBy("event_type").agg(value.alias("value"))
    return checked.withColumn("triggered", F.coalesce(F.col("value") != 0, F.lit(False)))


@query(
    "alert_log",
    """
    WITH r AS (SELECT date_trunc('day', ts)::TIMESTAMP AS run_at, event_type AS rule, sum(value) > 700 AS fired FROM events GROUP BY 1, 2),
    s AS (SELECT rule, run_at, CASE WHEN fired THEN 'Triggered' ELSE 'Not triggered' END AS state FROM r)
    SELECT rule, run_at, state, lag(state) OVER (PARTITION BY rule ORDER BY run_at) AS previous_state,
      coalesce(date_diff('second', max(CASE WHEN state = 'Triggered' THEN run_at END) OVER (PARTITION BY rule ORDER BY run_at
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), run_at) < 172800, false) AS in_grace FROM s
    """,
)
def alert_log(t: Tables) -> DataFrame:
    """Daily executions appended to a log, then read back with their grace period."""
    path = scratch_path(t.spark, "alert-log")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("run_at")
    daily = t("events").groupBy(F.col("event_type").alias("rule"), day).agg(F.sum("value").alias("value"))
    checked = daily.withColumn("triggered", alerts.compare(F.col("value"), ">", 700))
    alerts.append_log(checked, path, F.col("run_at"))
    return alerts.log_states(t.spark.read.parquet(path), ["rule"], "run_at", "state", 172_800)
