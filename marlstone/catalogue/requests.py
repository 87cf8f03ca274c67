"""Semantic requests: grouping, metrics, order, limits, samples, security, parameters."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.postprocess import contribution
from ..plans import builder
from ..plans.free_sql import run_free_sql
from ..plans.parameters import array_test, run_template
from ..plans.request import Dataset, Dim, Filter, Metric, Request, Rule
from ..plans.result_cache import ResultCache
from ..session import scratch_path
from .registry import Tables, query

NOW = datetime(2001, 12, 1)

REVENUE = Metric("revenue", expr="sum(l_extendedprice * (1 - l_discount))")
LINES = Metric("n_lines", "COUNT", "*")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round the floating columns, whose last digits depend on the order of addition."""
    return df.select(
        *[F.round(F.col(f"`{n}`"), digits).alias(n) if t in ("double", "float") else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def lineitem(t: Tables, **options) -> Dataset:
    return Dataset(t("lineitem"), time_column="l_shipdate", metrics={"revenue": REVENUE.expr}, **options)


def orders(t: Tables, **options) -> Dataset:
    return Dataset(t("orders"), time_column="o_orderdate", metrics={"total": "sum(o_totalprice)"}, **options)


@query(
    "flagship_revenue",
    """
    WITH m AS (
      SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS month, l_returnflag,
             sum(l_extendedprice * (1 - l_discount)) AS revenue
      FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-12-01'
      GROUP BY 1, 2),
    p AS (
      SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS month, l_returnflag,
             sum(l_extendedprice * (1 - l_discount)) AS revenue
      FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '2000-12-01'
      GROUP BY 1, 2)
    SELECT m.month, m.l_returnflag, round(m.revenue, 2) AS revenue,
           round(p.revenue, 2) AS "revenue__1 year ago",
           round(m.revenue / sum(m.revenue) OVER (), 8) AS share
    FROM m LEFT JOIN p ON p.month = m.month - INTERVAL 1 YEAR AND p.l_returnflag IS NOT DISTINCT FROM m.l_returnflag
    """,
)
def flagship_revenue(t: Tables) -> DataFrame:
    request = Request(
        columns=[Dim("month", "l_shipdate", "P1M"), "l_returnflag"],
        metrics=["revenue"],
        time_range="1996-01-01 : 2001-12-01",
        time_offsets=["1 year ago"],
    )
    df = builder.compile_request(lineitem(t), request, NOW)
    # the total comes from the range itself, whose shuffle is reused
    actual = builder.compile_request(lineitem(t), replace(request, time_offsets=()), NOW)
    df = contribution(df, "column", ["revenue"], rename_columns=["share"], totals_of=actual)
    return df.select(
        "month",
        "l_returnflag",
        F.round("revenue", 2).alias("revenue"),
        F.round(F.col("`revenue__1 year ago`"), 2).alias("revenue__1 year ago"),
        F.round("share", 8).alias("share"),
    )


@query(
    "topn_group",
    """
    SELECT p_brand, count(*)::BIGINT AS n_lines, round(avg(l_extendedprice), 4) AS avg_price
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-01'
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
    """,
)
def topn_group(t: Tables) -> DataFrame:
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    request = Request(
        columns=["p_brand"],
        metrics=[LINES, Metric("avg_price", "AVG", "l_extendedprice")],
        filters=[Filter("l_shipdate", "TEMPORAL_RANGE", "1996-01-01 : 2001-01-01")],
        order_by=[("n_lines", False), ("p_brand", True)],
        row_limit=10,
    )
    return rounded(builder.compile_request(Dataset(joined), request, NOW))


@query(
    "aggregate_query",
    """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*)::BIGINT AS n_lines
    FROM lineitem GROUP BY 1, 2
    """,
)
def aggregate_query(t: Tables) -> DataFrame:
    request = Request(columns=["l_returnflag", "l_linestatus"], metrics=[Metric("sum_qty", "SUM", "l_quantity"), "revenue", LINES])
    return rounded(builder.compile_request(lineitem(t), request, NOW), 2)


@query("columns_only", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def columns_only(t: Tables) -> DataFrame:
    return builder.compile_request(orders(t), Request(columns=["o_orderstatus", "o_orderpriority"], metrics=[]), NOW)


@query("raw_rows", "SELECT n_name, n_regionkey FROM nation")
def raw_rows(t: Tables) -> DataFrame:
    return builder.compile_request(Dataset(t("nation")), Request(columns=["n_name", "n_regionkey"], metrics=None), NOW)


@query(
    "metric_simple",
    """
    SELECT o_orderpriority, round(avg(o_totalprice), 4) AS m_avg, count(o_orderkey)::BIGINT AS m_count,
           count(DISTINCT o_custkey)::BIGINT AS m_distinct, max(o_totalprice) AS m_max,
           min(o_totalprice) AS m_min, round(sum(o_totalprice), 4) AS m_sum
    FROM orders GROUP BY 1
    """,
)
def metric_simple(t: Tables) -> DataFrame:
    metrics = [
        Metric("m_avg", "AVG", "o_totalprice"),
        Metric("m_count", "COUNT", "o_orderkey"),
        Metric("m_distinct", "COUNT_DISTINCT", "o_custkey"),
        Metric("m_max", "MAX", "o_totalprice"),
        Metric("m_min", "MIN", "o_totalprice"),
        Metric("m_sum", "SUM", "o_totalprice"),
    ]
    return rounded(builder.compile_request(orders(t), Request(columns=["o_orderpriority"], metrics=metrics), NOW))


@query(
    "metric_sql",
    """
    SELECT l_linestatus, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
           round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / count(*), 6) AS returned_per_line
    FROM lineitem GROUP BY 1
    """,
)
def metric_sql(t: Tables) -> DataFrame:
    ratio = Metric("returned_per_line", expr="sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / count(*)")
    out = builder.compile_request(lineitem(t), Request(columns=["l_linestatus"], metrics=["revenue", ratio]), NOW)
    return out.select("l_linestatus", F.round("revenue", 2).alias("revenue"), F.round("returned_per_line", 6).alias("returned_per_line"))


@query(
    "calculated_column",
    """
    SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class,
           upper(l_returnflag) AS flag, count(*)::BIGINT AS n_lines
    FROM lineitem GROUP BY 1, 2
    """,
)
def calculated_column(t: Tables) -> DataFrame:
    data = lineitem(
        t,
        calculated={
            "size_class": "CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END"
        },
    )
    request = Request(columns=["size_class", Dim("flag", "upper(l_returnflag)")], metrics=[LINES])
    return builder.compile_request(data, request, NOW)


@query(
    "where_having",
    """
    SELECT o_custkey, count(*)::BIGINT AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 1000
    GROUP BY 1 HAVING count(*) > 5
    """,
)
def where_having(t: Tables) -> DataFrame:
    request = Request(
        columns=["o_custkey"],
        metrics=[Metric("n_orders", "COUNT", "*"), "total"],
        where="o_orderstatus <> 'P' AND o_totalprice > 1000",
        having="n_orders > 5",
    )
    return rounded(builder.compile_request(orders(t), request, NOW), 2)


@query(
    "order_limit_offset",
    """
    SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders
    GROUP BY 1 ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 25 OFFSET 5
    """,
)
def order_limit_offset(t: Tables) -> DataFrame:
    request = Request(columns=["o_custkey"], metrics=["total"], order_by=[("total", False)], row_limit=25, row_offset=5)
    return rounded(builder.compile_request(orders(t), request, NOW), 2)


@query(
    "series_limit",
    """
    WITH best AS (SELECT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
                  GROUP BY 1 ORDER BY sum(l_quantity) DESC, p_brand LIMIT 5)
    SELECT date_trunc('quarter', l_shipdate)::TIMESTAMP AS __timestamp, p_brand, sum(l_quantity) AS qty
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_brand IN (SELECT p_brand FROM best) GROUP BY 1, 2
    """,
)
def series_limit(t: Tables) -> DataFrame:
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    request = Request(
        columns=["p_brand"],
        metrics=[Metric("qty", "SUM", "l_quantity")],
        grain="P3M",
        is_timeseries=True,
        series_columns=["p_brand"],
        series_limit=5,
    )
    return builder.compile_request(Dataset(joined, time_column="l_shipdate"), request, NOW)


@query("rowcount", "SELECT count(*)::BIGINT AS rowcount FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)")
def rowcount(t: Tables) -> DataFrame:
    request = Request(columns=["l_partkey", "l_suppkey"], metrics=[LINES], row_limit=10)
    return builder.row_count(lineitem(t), request, NOW)


@query(
    "totals_row",
    """
    SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, count(*)::BIGINT AS n_orders,
           grouping(o_orderstatus) > 0 AS is_total
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus), ())
    """,
)
def totals_row(t: Tables) -> DataFrame:
    request = Request(columns=["o_orderstatus"], metrics=["total", Metric("n_orders", "COUNT", "*")])
    return rounded(builder.with_total_row(orders(t), request, NOW), 2)


@query(
    "percent_metric",
    """
    SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total,
           round(sum(o_totalprice) / sum(sum(o_totalprice)) OVER (), 8) AS "%total"
    FROM orders GROUP BY 1
    """,
)
def percent_metric(t: Tables) -> DataFrame:
    request = Request(
        columns=["o_orderpriority"],
        metrics=["total"],
        post_processing=[("contribution", {"columns": ["total"], "rename_columns": ["%total"]})],
    )
    out = builder.compile_request(orders(t), request, NOW)
    return out.select("o_orderpriority", F.round("total", 2).alias("total"), F.round("%total", 8).alias("%total"))


@query("samples", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 50")
def samples(t: Tables) -> DataFrame:
    request = Request(time_range="1996-01-01 : 1997-01-01")
    return builder.samples(orders(t), request, NOW, ["o_orderkey"], page=2, per_page=50)


@query(
    "drill_detail",
    """
    SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
      AND o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 100
    """,
)
def drill_detail(t: Tables) -> DataFrame:
    request = Request(time_range="1996-01-01 : 1997-01-01", filters=[Filter("o_orderstatus", "==", "O")])
    return builder.samples(orders(t), request, NOW, ["o_orderkey"], per_page=100, drill=True)


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(t: Tables) -> DataFrame:
    return builder.distinct_values(Dataset(t("customer")), "c_mktsegment")


@query("columns_and_types")
def columns_and_types(t: Tables) -> DataFrame:
    return builder.columns_and_types(orders(t))


@query(
    "limit_probe",
    "SELECT CASE WHEN count(*) > 1000 THEN 'LIMITED' ELSE 'NOT_LIMITED' END AS limiting FROM lineitem",
)
def limit_probe(t: Tables) -> DataFrame:
    return builder.probe(t("lineitem"), 1000)[1]


@query(
    "result_normalise",
    """
    SELECT o_orderkey, o_orderdate + INTERVAL 2 HOUR AS from_epoch, o_orderdate + INTERVAL 2 HOUR AS from_ms,
           o_orderdate + INTERVAL 2 HOUR AS from_text,
           o_totalprice AS amount, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS ratio
    FROM orders
    """,
)
def result_normalise(t: Tables) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("o_orderdate"))
    raw = t("orders").select(
        "o_orderkey",
        seconds.alias("from_epoch"),
        (seconds * 1000).alias("from_ms"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("from_text"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(float("inf"))).otherwise(F.col("o_totalprice")).alias("ratio"),
    )
    return builder.normalise(
        raw, {"from_epoch": "epoch_s", "from_ms": "epoch_ms", "from_text": "%Y-%m-%d"}, ["amount"], hours=2
    )


@query(
    "nested_expand",
    """
    SELECT event_id, user_id AS "who.id", event_type AS "who.did.kind", value AS "who.did.amount",
           '["' || event_type || '","' || user_id || '"]' AS tags
    FROM events
    """,
)
def nested_expand(t: Tables) -> DataFrame:
    nested = t("events").select(
        "event_id",
        F.struct(
            F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("kind"), F.col("value").alias("amount")).alias("did")
        ).alias("who"),
        F.array(F.col("event_type"), F.col("user_id").cast("string")).alias("tags"),
    )
    return builder.expand_nested(nested)


@query(
    "dedup_labels",
    "SELECT n_name AS name, r_name AS name__1, n_regionkey AS key, r_regionkey AS key__1 "
    "FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def dedup_labels(t: Tables) -> DataFrame:
    joined = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_name", "r_name", "n_regionkey", "r_regionkey").toDF(
        *builder.unique(["name", "name", "key", "key"])
    )


@query(
    "row_level_security",
    """
    SELECT c_mktsegment, count(*)::BIGINT AS n FROM customer
    WHERE (c_nationkey < 5 OR c_nationkey > 20) AND (c_acctbal > 0) GROUP BY 1
    """,
)
def row_level_security(t: Tables) -> DataFrame:
    rules = [
        Rule("c_nationkey < 5", frozenset({"north"}), group="nation"),
        Rule("c_nationkey > 20", frozenset({"south"}), group="nation"),
        Rule("c_acctbal > 0", frozenset({"admin"}), kind="base"),
        Rule("c_mktsegment = 'BUILDING'", frozenset({"builder"})),
    ]
    data = Dataset(t("customer"), rules=rules, roles=["north", "south"])
    return builder.compile_request(data, Request(columns=["c_mktsegment"], metrics=[Metric("n", "COUNT", "*")]), NOW)


@query(
    "free_sql_security",
    """
    WITH c AS (SELECT * FROM customer WHERE (c_nationkey < 5 OR c_nationkey > 20) AND c_acctbal > 0),
    o AS (SELECT * FROM orders WHERE o_orderstatus <> 'P')
    SELECT c_mktsegment, count(*)::BIGINT AS n_orders, count(DISTINCT c_custkey)::BIGINT AS n_customers,
      (SELECT count(*) FROM c)::BIGINT AS n_visible, (SELECT count(*) FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM c))::BIGINT AS n_hidden
    FROM c JOIN o ON c_custkey = o_custkey WHERE EXISTS (SELECT 1 FROM o x WHERE x.o_custkey = c_custkey AND x.o_orderstatus = 'F')
    GROUP BY 1
    """,
)
def free_sql_security(t: Tables) -> DataFrame:
    """A user's own text: joins, aliases, subqueries and table expressions all see the rows of the roles."""
    customer = Dataset(
        t("customer"),
        rules=[
            Rule("c_nationkey < 5", frozenset({"north"}), group="nation"),
            Rule("c_nationkey > 20", frozenset({"south"}), group="nation"),
            Rule("c_acctbal > 0", frozenset({"admin"}), kind="base"),
        ],
        roles=["north", "south"],
    )
    orders = Dataset(t("orders"), rules=[Rule("o_orderstatus <> 'P'", frozenset({"admin"}), kind="base")], roles=["north"])
    text = """
        -- open and filled orders by segment
        WITH bought AS (SELECT a.c_mktsegment, a.c_custkey, b.o_orderkey FROM customer a JOIN ORDERS b ON a.c_custkey = b.o_custkey
          WHERE EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = a.c_custkey AND x.o_orderstatus = 'F'))
        SELECT c_mktsegment, count(*) AS n_orders, count(DISTINCT c_custkey) AS n_customers, (SELECT count(*) FROM customer) AS n_visible,
          (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS n_hidden
        FROM bought GROUP BY c_mktsegment
    """
    return run_free_sql(t.spark, text, {"customer": customer, "orders": orders})


@query(
    "parameterised_sql",
    """
    SELECT o_orderstatus, count(*)::BIGINT AS n FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
      AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1
    """,
)
def parameterised_sql(t: Tables) -> DataFrame:
    text = f"""
        SELECT o_orderstatus, count(*) AS n FROM {{orders}}
        WHERE {array_test('o_orderpriority', 'priorities')}
          AND o_orderdate >= :from_dttm AND o_orderdate < :to_dttm
        GROUP BY o_orderstatus
    """
    request = Request(
        filters=[Filter("o_orderpriority", "IN", ["1-URGENT", "2-HIGH"])], time_range="1997-01-01 : 2000-01-01"
    )
    return run_template(t.spark, text, request, NOW, {"priorities": "o_orderpriority"}, {"orders": t("orders")})


@query(
    "virtual_dataset",
    """
    SELECT r_name, count(*)::BIGINT AS n_customers, round(avg(c_acctbal), 4) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
    """,
)
def virtual_dataset(t: Tables) -> DataFrame:
    text = """SELECT c_acctbal, r_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
              JOIN {region} ON n_regionkey = r_regionkey"""
    df = run_template(t.spark, text, Request(), NOW, {}, {n: t(n) for n in ("customer", "nation", "region")})
    metrics = [Metric("n_customers", "COUNT", "*"), Metric("balance", "AVG", "c_acctbal")]
    return rounded(builder.compile_request(Dataset(df), Request(columns=["r_name"], metrics=metrics), NOW))


@query(
    "query_key_cache",
    "SELECT l_shipdate, count(*)::BIGINT AS n_lines FROM lineitem GROUP BY 1",
)
def query_key_cache(t: Tables) -> DataFrame:
    cache = ResultCache(t.spark, scratch_path(t.spark, "results"))
    request = Request(columns=["l_shipdate"], metrics=[LINES])
    cache.answer(t.path("lineitem"), lineitem(t), request, NOW)
    return cache.answer(t.path("lineitem"), lineitem(t), request, NOW)


@query("filter_accounting", "SELECT count(*)::BIGINT AS n FROM orders WHERE o_orderstatus = 'F'")
def filter_accounting(t: Tables) -> DataFrame:
    filters = [Filter("o_orderstatus", "==", "F"), Filter("not_there", "==", 1)]
    return builder.compile_request(orders(t), Request(metrics=[Metric("n", "COUNT", "*")], filters=filters), NOW)


@query(
    "mixed_query",
    """
    WITH a AS (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS __timestamp, sum(o_totalprice) AS v
               FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
         b AS (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS __timestamp, sum(o_totalprice) AS v
               FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
    SELECT coalesce(a.__timestamp, b.__timestamp) AS __timestamp, round(a.v, 2) AS "total (query A)",
           round(b.v, 2) AS "total (query B)"
    FROM a FULL JOIN b ON a.__timestamp = b.__timestamp
    """,
)
def mixed_query(t: Tables) -> DataFrame:
    parts = [
        builder.compile_request(
            orders(t),
            Request(metrics=["total"], is_timeseries=True, grain="P1M", filters=[Filter("o_orderstatus", "==", s)]),
            NOW,
        )
        for s in ("F", "P")
    ]
    return rounded(builder.side_by_side(*parts, on=["__timestamp"]), 2)


@query(
    "filter_options",
    """
    SELECT p_type, count(*)::BIGINT AS n FROM part WHERE p_type ILIKE '%a%' GROUP BY 1
    """,
)
def filter_options(t: Tables) -> DataFrame:
    return builder.filter_options(Dataset(t("part")), "p_type", "a", Metric("n", "COUNT", "*"), ascending=False)


@query(
    "range_bounds",
    "SELECT min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders WHERE o_orderstatus = 'O'",
)
def range_bounds(t: Tables) -> DataFrame:
    return builder.range_bounds(orders(t), "o_totalprice", Request(filters=[Filter("o_orderstatus", "==", "O")]), NOW)


@query(
    "merge_filters",
    """
    SELECT date_trunc('year', o_orderdate)::TIMESTAMP AS __timestamp, count(*)::BIGINT AS n FROM orders
    WHERE o_orderstatus = 'O' AND o_totalprice > 20000
      AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1
    """,
)
def merge_filters(t: Tables) -> DataFrame:
    request = Request(
        metrics=[Metric("n", "COUNT", "*")],
        filters=[Filter("o_orderstatus", "==", "O")],
        is_timeseries=True,
        grain="P1M",
        time_range="No filter",
    )
    extra = {"filters": [Filter("o_totalprice", ">", 20000)], "grain": "P1Y", "time_range": "1996-01-01 : 2000-01-01"}
    return builder.compile_request(orders(t), request.merged(extra), NOW)
