"""Pivot tables and the order of series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grains import bucket
from ..operators import pivots as pv
from .registry import Tables, query
from .requests import rounded


@query(
    "pivot_table_v2",
    """
    SELECT o_orderpriority,
      round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 4) AS "F, price",
      round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 4) AS "O, price",
      round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 4) AS "P, price"
    FROM orders GROUP BY 1
    """,
)
def pivot_table_v2(t: Tables) -> DataFrame:
    src = t("orders").withColumnRenamed("o_totalprice", "price")
    out = pv.pivot_table(src, ["o_orderpriority"], ["o_orderstatus"], ["price"], "Average", combine_metrics=True)
    return rounded(out)


@query(
    "pivot_metrics_on_rows",
    """
    WITH l AS (SELECT l_linestatus, l_returnflag, 'l_quantity' AS metric, l_quantity AS v FROM lineitem
               UNION ALL SELECT l_linestatus, l_returnflag, 'l_extendedprice', l_extendedprice FROM lineitem)
    SELECT l_linestatus, metric, round(sum(v) FILTER (WHERE l_returnflag = 'A'), 2) AS "value, A",
      round(sum(v) FILTER (WHERE l_returnflag = 'N'), 2) AS "value, N",
      round(sum(v) FILTER (WHERE l_returnflag = 'R'), 2) AS "value, R" FROM l GROUP BY 1, 2
    """,
)
def pivot_metrics_on_rows(t: Tables) -> DataFrame:
    out = pv.pivot_table(
        t("lineitem"), ["l_linestatus"], ["l_returnflag"], ["l_quantity", "l_extendedprice"], "Sum", metrics_on_rows=True
    )
    return rounded(out, 2)


@query(
    "pivot_subtotals",
    """
    WITH s AS (SELECT r_name, n_name, c_mktsegment, sum(c_acctbal) AS balance,
        grouping(r_name) AS g1, grouping(n_name) AS g2, grouping(c_mktsegment) AS g3
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      GROUP BY GROUPING SETS ((r_name, n_name, c_mktsegment), (r_name, c_mktsegment), (c_mktsegment), (r_name, n_name), (r_name), ()))
    SELECT CASE WHEN g1 = 1 THEN 'Total (Sum)' ELSE r_name END AS r_name,
      CASE WHEN g2 = 0 THEN n_name WHEN g1 = 0 THEN 'Subtotal' ELSE '' END AS n_name,
      CASE WHEN g3 = 1 THEN 'Total (Sum)' ELSE c_mktsegment END AS c_mktsegment, round(balance, 2) AS balance FROM s
    """,
)
def pivot_subtotals(t: Tables) -> DataFrame:
    joined = (
        t("customer")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    out = pv.subtotals(joined, ["r_name", "n_name"], ["c_mktsegment"], {"balance": F.sum("c_acctbal")})
    return rounded(out, 2)


@query(
    "pivot_cell_totals",
    """
    WITH cells AS (SELECT r_name, n_name, c_mktsegment, avg(c_acctbal) AS v
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3),
    across AS (SELECT * FROM cells UNION ALL SELECT r_name, n_name, 'Total (Average)', avg(v) FROM cells GROUP BY 1, 2)
    SELECT r_name, n_name, c_mktsegment, round(v, 6) AS balance FROM across
    UNION ALL SELECT r_name, 'Subtotal', c_mktsegment, round(avg(v), 6) FROM across GROUP BY 1, 3
    UNION ALL SELECT 'Total (Average)', '', c_mktsegment, round(avg(v), 6) FROM across GROUP BY 3
    """,
)
def pivot_cell_totals(t: Tables) -> DataFrame:
    """Averages of averages: every level from the cells below it."""
    joined = (
        t("customer")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    out = pv.cell_subtotals(joined, ["r_name", "n_name"], ["c_mktsegment"], {"balance": F.avg("c_acctbal")})
    return rounded(out, 6)


@query(
    "pivot_fractions",
    """
    WITH c AS (SELECT o_orderpriority AS r, o_orderstatus AS c, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
    SELECT r, c, round(v / sum(v) OVER (), 8) AS of_total, round(v / sum(v) OVER (PARTITION BY r), 8) AS of_row,
      round(v / sum(v) OVER (PARTITION BY c), 8) AS of_column FROM c
    """,
)
def pivot_fractions(t: Tables) -> DataFrame:
    cells = t("orders").groupBy(F.col("o_orderpriority").alias("r"), F.col("o_orderstatus").alias("c")).agg(
        F.sum("o_totalprice").alias("v")
    )
    out = cells
    for axis, name in (("total", "of_total"), ("rows", "of_row"), ("columns", "of_column")):
        out = pv.fractions(out, "v", axis, ["r"], ["c"]).withColumnRenamed("fraction", name)
    return rounded(out.drop("v"), 8)


_FUNCTIONS = (
    "Count", "Count Unique Values", "List Unique Values", "Sum", "Integer Sum", "Average", "Median", "Sample Variance",
    "Sample Standard Deviation", "Minimum", "Maximum", "First", "Last", "Sum over Sum",
)


@query(
    "pivot_aggregators",
    """
    WITH e AS (SELECT event_type, (event_id % 5)::BIGINT AS slot, ts, event_id, floor(value) AS v, value + 1 AS w FROM events)
    SELECT event_type, slot, count(v)::BIGINT AS "Count", count(DISTINCT v)::BIGINT AS "Count Unique Values",
      sum(v) AS "Sum", sum(v)::BIGINT AS "Integer Sum", round(avg(v), 6) AS "Average",
      quantile_cont(v, 0.5) AS "Median", round(CASE WHEN count(v) = 1 THEN 0 ELSE var_samp(v) END, 4) AS "Sample Variance",
      round(CASE WHEN count(v) = 1 THEN 0 ELSE stddev_samp(v) END, 6) AS "Sample Standard Deviation",
      min(v) AS "Minimum", max(v) AS "Maximum", arg_min(v, event_id) AS "First", arg_max(v, event_id) AS "Last",
      round(sum(v) / sum(w), 8) AS "Sum over Sum"
    FROM e GROUP BY 1, 2
    """,
)
def pivot_aggregators(t: Tables) -> DataFrame:
    e = t("events").select(
        "event_type", (F.col("event_id") % 5).alias("slot"), "event_id",
        F.floor("value").cast("double").alias("v"), (F.col("value") + 1).alias("w"),
    )
    plain = [f for f in _FUNCTIONS if f not in ("Median", "List Unique Values")]
    cells = e.groupBy("event_type", "slot").agg(
        *[pv.aggregator(f, F.col("v"), F.col("event_id"), F.col("w")).alias(f) for f in plain]
    )
    median = pv.pivot_long(e, ["event_type", "slot"], "v", "Median").withColumnRenamed("value", "Median")
    digits = {"Average": 6, "Sample Variance": 4, "Sample Standard Deviation": 6, "Sum over Sum": 8}
    out = cells.join(median, ["event_type", "slot"])
    return out.select(*[F.round(F.col(f"`{c}`"), digits[c]).alias(c) if c in digits else F.col(f"`{c}`") for c in out.columns])


@query(
    "pivot_list_unique",
    "SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS value FROM orders GROUP BY 1",
)
def pivot_list_unique(t: Tables) -> DataFrame:
    return pv.pivot_long(t("orders"), ["o_orderstatus"], "o_orderpriority", "List Unique Values")


@query(
    "series_order",
    """
    WITH m AS (SELECT date_trunc('year', o_orderdate)::TIMESTAMP AS year, o_orderpriority, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS v
               FROM orders GROUP BY 1, 2),
    s AS (SELECT o_orderpriority, row_number() OVER (ORDER BY max(v) DESC, o_orderpriority) AS series_rank FROM m GROUP BY 1)
    SELECT year, o_orderpriority, v, series_rank FROM m JOIN s USING (o_orderpriority)
    """,
)
def series_order(t: Tables) -> DataFrame:
    m = t("orders").groupBy(bucket(F.col("o_orderdate"), "P1Y").alias("year"), "o_orderpriority").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("v")
    )
    return pv.series_order(m, ["o_orderpriority"], "v", "max")


@query(
    "stack_totals",
    """
    SELECT date_trunc('month', ts)::TIMESTAMP AS month, round(sum(value), 4) AS total, round(0.05 * sum(value), 4) AS threshold
    FROM events GROUP BY 1
    """,
)
def stack_totals(t: Tables) -> DataFrame:
    m = t("events").groupBy(bucket(F.col("ts"), "P1M").alias("month"), "event_type").agg(F.sum("value").alias("v"))
    return rounded(pv.stack_totals(m, "month", "v", 5.0))


@query(
    "axis_sort",
    "SELECT p_size, count(*)::BIGINT AS n FROM part GROUP BY 1 ORDER BY n DESC, p_size",
)
def axis_sort(t: Tables) -> DataFrame:
    return pv.axis_sort(t("part").groupBy("p_size").agg(F.count(F.lit(1)).alias("n")), "p_size", "n", False)


@query(
    "pivot_sort",
    """
    WITH b AS (SELECT p_brand, sum(p_retailprice) AS v FROM part GROUP BY 1)
    SELECT p_brand, round(v, 2) AS v, row_number() OVER (ORDER BY regexp_extract(p_brand, '\\d+')::INT) AS place FROM b
    """,
)
def pivot_sort(t: Tables) -> DataFrame:
    from ..operators.ordered import Running, running

    b = t("part").groupBy("p_brand").agg(F.sum("p_retailprice").alias("v")).withColumn("__key", pv.natural_key(F.col("p_brand")))
    placed = running(b, [], [("__key", True)], {"place": Running("row_number")})
    return pv.pivot_sort(rounded(placed.drop("__key"), 2), "p_brand", "v")
