"""Data transforms of the analytic charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grains import bucket
from ..operators import charts as ch
from .registry import Tables, query
from .requests import rounded


@query(
    "histogram",
    """
    WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    c AS (SELECT o_orderstatus, least(floor((o_totalprice - lo) / (hi - lo) * 15)::INT, 14) AS bin, count(*) AS n
          FROM orders, e GROUP BY 1, 2),
    g AS (SELECT o_orderstatus, unnest(range(15))::INT AS bin FROM (SELECT DISTINCT o_orderstatus FROM orders))
    SELECT g.o_orderstatus, g.bin, round(lo + g.bin * (hi - lo) / 15, 4) AS x0, round(lo + (g.bin + 1) * (hi - lo) / 15, 4) AS x1,
      round(sum(coalesce(n, 0)) OVER (PARTITION BY g.o_orderstatus ORDER BY g.bin)
        / sum(coalesce(n, 0)) OVER (PARTITION BY g.o_orderstatus), 8)::DOUBLE AS value
    FROM g LEFT JOIN c ON c.o_orderstatus = g.o_orderstatus AND c.bin = g.bin, e
    """,
)
def histogram(t: Tables) -> DataFrame:
    out = ch.histogram(t("orders"), "o_totalprice", 15, ["o_orderstatus"], normalized=True, cumulative=True)
    return out.select("o_orderstatus", "bin", F.round("x0", 4).alias("x0"), F.round("x1", 4).alias("x1"), F.round("value", 8).alias("value"))


@query(
    "waterfall",
    """
    WITH p AS (SELECT date_trunc('year', o_orderdate)::DATE::VARCHAR AS year, sum(o_totalprice) AS v FROM orders GROUP BY 1),
    s AS (SELECT year, v, sum(v) OVER (ORDER BY year) AS after FROM p)
    SELECT year, round(v, 2) AS v, round(after - v, 2) + 0.0 AS level_before, round(after, 2) AS level_after, false AS is_total FROM s
    UNION ALL SELECT 'Total', round(sum(v), 2), 0.0, round(sum(v), 2), true FROM p
    """,
)
def waterfall(t: Tables) -> DataFrame:
    p = t("orders").groupBy(F.date_trunc("year", "o_orderdate").cast("date").alias("year")).agg(F.sum("o_totalprice").alias("v"))
    return rounded(ch.waterfall(p, "year", "v"), 2)


@query(
    "waterfall_breakdown",
    """
    WITH p AS (SELECT year(o_orderdate)::VARCHAR AS year, o_orderstatus, sum(o_totalprice) AS v FROM orders
               GROUP BY GROUPING SETS ((1, 2), (1)))
    SELECT year, coalesce(o_orderstatus, 'Total') AS o_orderstatus, round(v, 2) AS v,
      o_orderstatus IS NULL AS is_total FROM p
    """,
)
def waterfall_breakdown(t: Tables) -> DataFrame:
    p = t("orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.sum("o_totalprice").alias("v"))
    return rounded(ch.waterfall(p, "year", "v", "o_orderstatus"), 2).select("year", "o_orderstatus", "v", "is_total")


@query(
    "tree_rollup",
    """
    SELECT r_name, n_name, c_mktsegment, round(sum(c_acctbal), 2) AS value, count(*)::DOUBLE AS secondary_value,
      (3 - grouping(r_name) - grouping(n_name) - grouping(c_mktsegment))::INTEGER AS depth
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY GROUPING SETS ((r_name), (r_name, n_name), (r_name, n_name, c_mktsegment))
    """,
)
def tree_rollup(t: Tables) -> DataFrame:
    joined = (
        t("customer")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("one", F.lit(1))
    )
    return rounded(ch.tree_rollup(joined, ["r_name", "n_name", "c_mktsegment"], "c_acctbal", "one"), 2)


def _links(t: Tables) -> DataFrame:
    """Trade between customer and supplier nations."""
    return (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("c_nationkey").alias("source"), F.col("s_nationkey").alias("target"))
        .agg(F.sum("l_quantity").alias("value"))
    )


_LINKS = """
    WITH l AS (SELECT c_nationkey AS source, s_nationkey AS target, sum(l_quantity) AS value
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
"""


@query(
    "node_edge_totals",
    _LINKS
    + """
    SELECT node, sum(value) AS total, count(*)::BIGINT AS links
    FROM (SELECT source AS node, value FROM l UNION ALL SELECT target, value FROM l) GROUP BY 1
    """,
)
def node_edge_totals(t: Tables) -> DataFrame:
    return ch.node_totals(_links(t), "source", "target", "value")


@query(
    "chord_matrix",
    _LINKS
    + """
    , n AS (SELECT node, (row_number() OVER (ORDER BY node) - 1)::BIGINT AS place
            FROM (SELECT source AS node FROM l UNION SELECT target FROM l))
    SELECT source, target, a.place AS row, b.place AS col, value AS flow
    FROM l JOIN n a ON a.node = source JOIN n b ON b.node = target
    """,
)
def chord_matrix(t: Tables) -> DataFrame:
    return ch.chord_matrix(_links(t), "source", "target", "value")


@query(
    "funnel",
    """
    WITH s AS (SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1)
    SELECT event_type, n, row_number() OVER w AS position, round(n / first_value(n) OVER w, 8) AS share_of_first,
      round(coalesce(n / lag(n) OVER w, 1.0), 8) AS share_of_previous, round(n / sum(n) OVER (), 8) AS share_of_total
    FROM s WINDOW w AS (ORDER BY n DESC, event_type)
    """,
)
def funnel(t: Tables) -> DataFrame:
    return rounded(ch.funnel(t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "event_type", "n"), 8)


@query(
    "pie_share",
    """
    WITH s AS (SELECT c_mktsegment, sum(c_acctbal) AS v FROM customer GROUP BY 1)
    SELECT c_mktsegment, round(v, 6) AS v, round(v / sum(v) OVER (), 6) AS share, round(sum(v) OVER (), 6) AS total FROM s
    """,
)
def pie_share(t: Tables) -> DataFrame:
    return rounded(ch.pie_share(t("customer").groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("v")), "c_mktsegment", "v"), 6)


@query(
    "boxplot_query",
    """
    WITH d AS (SELECT date_trunc('month', o_orderdate) AS m, o_orderstatus AS s, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
    SELECT s AS o_orderstatus, round(avg(v), 2) AS v__mean, round(max(v), 2) AS v__max, round(min(v), 2) AS v__min,
      count(*)::BIGINT AS v__count FROM d GROUP BY 1
    """,
)
def boxplot_query(t: Tables) -> DataFrame:
    from ..operators.postprocess import boxplot

    d = t("orders").groupBy(bucket(F.col("o_orderdate"), "P1M").alias("m"), "o_orderstatus").agg(F.sum("o_totalprice").alias("v"))
    out = boxplot(d, ["o_orderstatus"], ["v"], "min/max", outliers="count")
    return rounded(out.select("o_orderstatus", "v__mean", "v__max", "v__min", "v__count"), 2)


@query(
    "bubble",
    """
    SELECT p_brand, p_type, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(*) AS x, sum(l_quantity) / count(*) AS y, count(*)::BIGINT AS size
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
    """,
)
def bubble(t: Tables) -> DataFrame:
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_brand", "p_type").agg(
        (F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("x"),
        (F.sum("l_quantity") / F.count(F.lit(1))).alias("y"),
        F.count(F.lit(1)).alias("size"),
    )


@query(
    "paired_t_test",
    """
    WITH d AS (SELECT date_trunc('day', ts) AS day, event_type AS s, sum(value) AS v FROM events GROUP BY 1, 2),
    p AS (SELECT a.s, a.v, c.v AS c, a.v - c.v AS d FROM d a JOIN d c ON c.day = a.day AND c.s = 'view' WHERE a.s <> 'view')
    SELECT s AS series, round((sum(v) - sum(c)) / sum(c) * 100, 4) AS lift_percent,
      round(avg(d) / (stddev_samp(d) / sqrt(count(*))), 6) AS t_statistic, (count(*) - 1)::BIGINT AS freedom FROM p GROUP BY 1
    """,
)
def paired_t_test(t: Tables) -> DataFrame:
    d = t("events").groupBy(bucket(F.col("ts"), "P1D").alias("day"), "event_type").agg(F.sum("value").alias("v"))
    out = ch.paired_t_test(d, "day", "event_type", "v", "view")
    return out.select("series", "lift_percent", F.round("t_statistic", 6).alias("t_statistic"), "freedom")


@query(
    "event_paths",
    """
    WITH s AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    p AS (SELECT user_id, i, string_agg(event_type, ' > ') OVER (PARTITION BY user_id ORDER BY i) AS path FROM s)
    SELECT path, count(*)::BIGINT AS entities, i::INTEGER AS depth FROM p GROUP BY path, i
    """,
)
def event_paths(t: Tables) -> DataFrame:
    return ch.event_paths(t("events"), "user_id", "event_type", "ts", "event_id")


@query(
    "calendar_buckets",
    """
    SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS domain, date_trunc('day', o_orderdate)::TIMESTAMP AS subdomain,
      round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1, 2
    """,
)
def calendar_buckets(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return rounded(ch.calendar_buckets(t("orders"), bucket(d, "P1M"), bucket(d, "P1D"), F.col("o_totalprice")), 2)


@query(
    "break_points",
    """
    WITH e AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
    SELECT c_custkey, least(floor((c_acctbal - lo) / (hi - lo) * 10)::INTEGER, 9) AS bucket,
      ((c_acctbal >= 0)::INT + (c_acctbal >= 2500)::INT + (c_acctbal >= 7500)::INT)::INTEGER AS given
    FROM customer, e
    """,
)
def break_points(t: Tables) -> DataFrame:
    equal = ch.break_points(t("customer"), "c_acctbal").withColumnRenamed("bucket", "equal_width")
    out = ch.break_points(equal, "c_acctbal", points=[-1000, 0, 2500, 7500, 10000])
    return out.select("c_custkey", F.col("equal_width").alias("bucket"), F.col("bucket").alias("given"))


@query(
    "interval_annotations",
    """
    WITH a AS (SELECT user_id, min(ts) AS s, max(ts) AS e FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT event_id, user_id::VARCHAR AS short_descr FROM
      (SELECT event_id, ts FROM events WHERE event_type = 'purchase') x JOIN
      (SELECT user_id, s, s + INTERVAL 6 HOUR AS e FROM a) i ON ts >= s AND ts <= e
    """,
)
def interval_annotations(t: Tables) -> DataFrame:
    """Purchases in the six hours after a user's first error."""
    notes = (
        t("events")
        .filter("event_type = 'error'")
        .groupBy("user_id")
        .agg(F.min("ts").alias("start_dttm"))
        .select(
            "start_dttm",
            F.timestamp_add("HOUR", F.lit(6), F.col("start_dttm")).alias("end_dttm"),
            F.col("user_id").cast("string").alias("short_descr"),
        )
    )
    rows = t("events").filter("event_type = 'purchase'").select("event_id", "ts")
    return ch.interval_annotations(rows, "ts", notes, "hour").select("event_id", "short_descr")


@query(
    "interval_annotations_long",
    """
    WITH i AS (SELECT user_id::VARCHAR AS short_descr, min(ts) AS s, max(ts) + INTERVAL (user_id % 3) YEAR AS e FROM events GROUP BY user_id)
    SELECT short_descr, count(*)::BIGINT AS n, min(event_id)::BIGINT AS first_event FROM (SELECT event_id, ts FROM events WHERE event_type = 'error') x JOIN i ON ts >= s AND ts <= e
    GROUP BY 1
    """,
)
def interval_annotations_long(t: Tables) -> DataFrame:
    """Errors within the whole time of every user, some years more for some, from totals of slices of the times."""
    notes = t("events").groupBy("user_id").agg(F.min("ts").alias("start_dttm"), F.max("ts").alias("last")).select(
        "start_dttm",
        (F.col("last") + F.make_ym_interval((F.col("user_id") % 3).cast("int"))).alias("end_dttm"),
        F.col("user_id").cast("string").alias("short_descr"),
    )
    rows = t("events").filter("event_type = 'error'").select("event_id", "ts")
    return ch.interval_annotations(rows, "ts", notes, "minute", totals={"n": ("count", None), "first_event": ("min", "event_id")})


@query(
    "formula_series",
    """
    SELECT o_orderkey, round(2 * sin(epoch_ms(o_orderdate) / 1e10) + 3, 8) AS y FROM orders
    """,
)
def formula_series(t: Tables) -> DataFrame:
    out = ch.formula_series(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "2 * sin(x / 1e10) + 3", "y")
    return out.select("o_orderkey", F.round("y", 8).alias("y"))


@query(
    "series_annotation",
    """
    WITH a AS (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, sum(o_totalprice) AS total FROM orders GROUP BY 1),
    b AS (SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS month, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
    SELECT a.month, round(total, 2) AS total, qty AS shipped FROM a LEFT JOIN b USING (month)
    """,
)
def series_annotation(t: Tables) -> DataFrame:
    a = t("orders").groupBy(bucket(F.col("o_orderdate"), "P1M").alias("month")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    b = t("lineitem").groupBy(bucket(F.col("l_shipdate"), "P1M").alias("m")).agg(F.sum("l_quantity").alias("qty"))
    return ch.series_annotation(a, "month", b, "m", "qty", "shipped")


@query(
    "heatmap_share",
    """
    WITH c AS (SELECT p_brand AS x, p_type AS y, sum(p_retailprice::DECIMAL(18,2))::DOUBLE AS v FROM part GROUP BY 1, 2)
    SELECT x, y, round((v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()), 8) AS perc_all,
      round(percent_rank() OVER (ORDER BY v), 8) AS rank_all,
      round((v - min(v) OVER (PARTITION BY x)) / (max(v) OVER (PARTITION BY x) - min(v) OVER (PARTITION BY x)), 8) AS perc_x,
      round(percent_rank() OVER (PARTITION BY x ORDER BY v), 8) AS rank_x FROM c
    """,
)
def heatmap_share(t: Tables) -> DataFrame:
    c = t("part").groupBy(F.col("p_brand").alias("x"), F.col("p_type").alias("y")).agg(
        F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double").alias("v")
    )
    grid = ch.heatmap_share(c, "x", "y", "v").withColumnsRenamed({"perc": "perc_all", "rank": "rank_all"})
    out = ch.heatmap_share(grid, "x", "y", "v", "x").withColumnsRenamed({"perc": "perc_x", "rank": "rank_x"})
    return rounded(out.drop("v"), 8)


@query(
    "partition_levels",
    """
    SELECT o_orderstatus, o_orderpriority, (2 - grouping(o_orderstatus) - grouping(o_orderpriority))::INTEGER AS depth,
      round(sum(o_totalprice) FILTER (WHERE year(o_orderdate) = 2000) / sum(o_totalprice) FILTER (WHERE year(o_orderdate) = 1996), 8) AS value
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderstatus, o_orderpriority))
    """,
)
def partition_levels(t: Tables) -> DataFrame:
    out = ch.partition_levels(
        t("orders"), ["o_orderstatus", "o_orderpriority"], "o_totalprice", option="point_factor",
        start=F.year("o_orderdate") == 1996, end=F.year("o_orderdate") == 2000,
    )
    return rounded(out, 8)


@query(
    "partition_mean",
    """
    SELECT o_orderstatus, o_orderpriority, (2 - grouping(o_orderstatus) - grouping(o_orderpriority))::INTEGER AS depth,
      round(sum(o_totalprice) / (SELECT count(DISTINCT year(o_orderdate)) FROM orders), 2) AS value
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderstatus, o_orderpriority))
    """,
)
def partition_mean(t: Tables) -> DataFrame:
    src = t("orders").withColumn("year", F.year("o_orderdate"))
    return rounded(ch.partition_levels(src, ["o_orderstatus", "o_orderpriority"], "o_totalprice", "year", "mean"), 2)


@query(
    "plain_charts",
    """
    SELECT 'word cloud' AS chart, p_name AS name, count(*)::DOUBLE AS value FROM part GROUP BY 2
    UNION ALL SELECT 'gauge', p_brand, round(avg(p_retailprice), 4) FROM part GROUP BY 2
    UNION ALL SELECT 'big total', NULL, round(sum(p_retailprice), 2) FROM part
    """,
)
def plain_charts(t: Tables) -> DataFrame:
    """Charts that are a grouping and nothing more."""
    from datetime import datetime

    from ..plans.builder import compile_request
    from ..plans.request import Dataset, Metric, Request

    data, now = Dataset(t("part")), datetime(2001, 12, 1)
    cloud = compile_request(data, Request(columns=["p_name"], metrics=[Metric("value", expr="cast(count(*) as double)")]), now)
    gauge = compile_request(data, Request(columns=["p_brand"], metrics=[Metric("value", expr="round(avg(p_retailprice), 4)")]), now)
    total = compile_request(data, Request(metrics=[Metric("value", expr="round(sum(p_retailprice), 2)")]), now)
    parts = [
        cloud.select(F.lit("word cloud").alias("chart"), F.col("p_name").alias("name"), "value"),
        gauge.select(F.lit("gauge").alias("chart"), F.col("p_brand").alias("name"), "value"),
        total.select(F.lit("big total").alias("chart"), F.lit(None).cast("string").alias("name"), "value"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
