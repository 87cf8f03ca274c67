"""Joins, grouping, windows, set operations and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grains import bucket
from ..operators import relational as rel
from ..operators.ordered import Running, running, sliding
from .registry import Tables, query
from .requests import rounded


@query(
    "join_inner",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def join_inner(t: Tables) -> DataFrame:
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"), "inner")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_name")


@query(
    "join_left",
    """
    SELECT c_custkey, c_name, n AS n_right FROM customer LEFT JOIN
      (SELECT o_custkey, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey
    """,
)
def join_left(t: Tables) -> DataFrame:
    pending = t("orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return rel.left_join(t("customer").select("c_custkey", "c_name"), pending, ["c_custkey"], "_right", always_suffix=True)


@query(
    "join_right",
    """
    SELECT n, c_custkey FROM (SELECT o_custkey, count(*)::BIGINT AS n FROM orders WHERE o_totalprice > 400000 GROUP BY 1)
    RIGHT JOIN customer ON o_custkey = c_custkey
    """,
)
def join_right(t: Tables) -> DataFrame:
    big = t("orders").filter("o_totalprice > 400000").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return big.join(t("customer"), F.col("o_custkey") == F.col("c_custkey"), "right").select("n", "c_custkey")


@query(
    "join_full",
    """
    SELECT c, c_n, s, s_n FROM (SELECT c_nationkey AS c, count(*)::BIGINT AS c_n FROM customer WHERE c_acctbal < 0 GROUP BY 1)
    FULL JOIN (SELECT s_nationkey AS s, count(*)::BIGINT AS s_n FROM supplier WHERE s_acctbal > 3000 GROUP BY 1) ON c = s
    """,
)
def join_full(t: Tables) -> DataFrame:
    c = t("customer").filter("c_acctbal < 0").groupBy(F.col("c_nationkey").alias("c")).agg(F.count(F.lit(1)).alias("c_n"))
    s = t("supplier").filter("s_acctbal > 3000").groupBy(F.col("s_nationkey").alias("s")).agg(F.count(F.lit(1)).alias("s_n"))
    return c.join(s, F.col("c") == F.col("s"), "full")


@query(
    "cogroup",
    """
    SELECT n_nationkey AS key, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey)::BIGINT AS left_rows,
      (SELECT round(sum(c_acctbal), 2) FROM customer WHERE c_nationkey = n_nationkey) AS left_sum,
      (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey)::BIGINT AS right_rows,
      (SELECT round(sum(s_acctbal), 2) FROM supplier WHERE s_nationkey = n_nationkey) AS right_sum
    FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
    """,
)
def cogroup(t: Tables) -> DataFrame:
    tagged = rel.cogroup(
        t("customer").select(F.col("c_nationkey").alias("key"), F.col("c_acctbal").alias("v")),
        t("supplier").select(F.col("s_nationkey").alias("key"), F.col("s_acctbal").alias("v")),
        ["key"],
    )
    left, right = F.col("side") == "left", F.col("side") == "right"
    out = tagged.groupBy("key").agg(
        F.count_if(left).alias("left_rows"),
        F.sum(F.when(left, F.col("v"))).alias("left_sum"),
        F.count_if(right).alias("right_rows"),
        F.sum(F.when(right, F.col("v"))).alias("right_sum"),
    )
    return rounded(out, 2)


@query("join_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def join_semi(t: Tables) -> DataFrame:
    urgent = t("orders").filter("o_orderpriority = '1-URGENT'")
    return t("customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("join_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def join_anti(t: Tables) -> DataFrame:
    urgent = t("orders").filter("o_orderpriority = '1-URGENT'")
    return t("customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query(
    "broadcast_lookup",
    """
    SELECT r_name, count(*)::BIGINT AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
    """,
)
def broadcast_lookup(t: Tables) -> DataFrame:
    lookup = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    named = rel.lookup_join(t("customer"), lookup, "c_nationkey", "n_nationkey")
    joined = t("orders").join(named, F.col("o_custkey") == F.col("c_custkey"))
    return rounded(joined.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), 2)


@query(
    "group_shortcuts",
    """
    SELECT p_type, count(*)::BIGINT AS count, round(avg(p_retailprice), 4) AS mean, max(p_size) AS max, min(p_size) AS min,
      sum(p_size)::BIGINT AS sum FROM part GROUP BY 1
    """,
)
def group_shortcuts(t: Tables) -> DataFrame:
    return t("part").groupBy("p_type").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.mean("p_retailprice"), 4).alias("mean"), F.max("p_size").alias("max"),
        F.min("p_size").alias("min"), F.sum("p_size").alias("sum"),
    )


@query(
    "group_pivot",
    """
    SELECT year(o_orderdate)::INTEGER AS year, count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS "F",
      count(*) FILTER (WHERE o_orderstatus = 'O')::BIGINT AS "O", count(*) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS "P"
    FROM orders GROUP BY 1
    """,
)
def group_pivot(t: Tables) -> DataFrame:
    return t("orders").groupBy(F.year("o_orderdate").alias("year")).pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)


@query(
    "rollup_cube_sets",
    """
    SELECT 'rollup' AS kind, l_returnflag, l_linestatus, count(*)::BIGINT AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
    UNION ALL SELECT 'cube', l_returnflag, l_linestatus, count(*) FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
    UNION ALL SELECT 'sets', l_returnflag, l_linestatus, count(*) FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus))
    """,
)
def rollup_cube_sets(t: Tables) -> DataFrame:
    li, n = t("lineitem"), F.count(F.lit(1)).alias("n")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    parts = {
        "rollup": li.rollup(flag, status).agg(n),
        "cube": li.cube(flag, status).agg(n),
        "sets": li.groupingSets([[flag], [status]], flag, status).agg(n),
    }
    out = None
    for kind, part in parts.items():
        part = part.select(F.lit(kind).alias("kind"), "l_returnflag", "l_linestatus", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "stat_counter",
    """
    SELECT count(value)::BIGINT AS count, round(avg(value), 8) AS mean, round(sum(value), 4) AS sum, min(value) AS min, max(value) AS max,
      round(var_pop(value), 4) AS variance, round(var_samp(value), 4) AS sample_variance, round(stddev_pop(value), 6) AS stdev,
      round(stddev_samp(value), 6) AS sample_stdev FROM events
    """,
)
def stat_counter(t: Tables) -> DataFrame:
    return rel.stat_counter(t("events"), "value")


@query(
    "word_count",
    """
    SELECT word, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1
    """,
)
def word_count(t: Tables) -> DataFrame:
    return rel.word_count(t("documents"), "text")


def _log_lines(t: Tables) -> DataFrame:
    """Access-log lines written from the events; errors are cut short and do not parse."""
    full = F.concat(
        F.lit("10.0.0."), (F.col("user_id") % 20).cast("string"), F.lit(" - u"), F.col("user_id").cast("string"),
        F.lit(' ["GET /'), F.col("event_type"), F.lit('?k=1"] 200 '), F.floor(F.col("value") * 100).cast("string"),
    )
    return t("events").select(F.when(F.col("event_type") == "error", F.lit("broken line")).otherwise(full).alias("line"))


@query(
    "log_query",
    """
    SELECT CASE WHEN event_type <> 'error' THEN '10.0.0.' || (user_id % 20) END AS ip,
      CASE WHEN event_type <> 'error' THEN 'u' || user_id END AS user,
      CASE WHEN event_type <> 'error' THEN 'GET /' || event_type || '?k=1' END AS query, count(*)::BIGINT AS n,
      sum(CASE WHEN event_type <> 'error' THEN floor(value * 100)::BIGINT END)::BIGINT AS bytes
    FROM events GROUP BY 1, 2, 3
    """,
)
def log_query(t: Tables) -> DataFrame:
    return rel.log_query(_log_lines(t), "line")


@query(
    "skewed_group",
    """
    SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS key, count(*)::BIGINT AS n, sum(l_quantity) AS qty,
      count(DISTINCT l_suppkey)::BIGINT AS suppliers FROM lineitem GROUP BY 1
    """,
)
def skewed_group(t: Tables) -> DataFrame:
    """A key that holds a third of the rows, in two stages."""
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_partkey"))
    src = t("lineitem").select(key.alias("key"), "l_suppkey", "l_quantity")
    return rel.salted_group(src, ["key"], "l_suppkey", {"n": ("count", None), "qty": ("sum", "l_quantity")}, "suppliers")


@query(
    "window_rank",
    """
    SELECT event_id, row_number() OVER w AS rn, rank() OVER v AS rk, dense_rank() OVER v AS drk,
      round(percent_rank() OVER v, 8) AS prk, round(cume_dist() OVER v, 8) AS cd, ntile(7) OVER w AS tile,
      first_value(value) OVER w AS first_value, sum(value::DECIMAL(18,2)) OVER (w ROWS UNBOUNDED PRECEDING)::DOUBLE AS running
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id), v AS (PARTITION BY event_type ORDER BY floor(value))
    """,
)
def window_rank(t: Tables) -> DataFrame:
    """Ranks within five keys that share the table: chunked, no key in one task."""
    src = t("events").select(
        "event_id", "event_type", "ts", "value", F.floor("value").alias("level"), F.col("value").cast("decimal(18,2)").alias("exact")
    )
    by_time = running(
        src,
        ["event_type"],
        [("ts", True), ("event_id", True)],
        {
            "rn": Running("row_number"), "tile": Running("ntile", n=7), "first_value": Running("first_value", "value"),
            "running": Running("sum", "exact"),
        },
    )
    out = running(
        by_time,
        ["event_type"],
        [("level", True)],
        {"rk": Running("rank"), "drk": Running("dense_rank"), "prk": Running("percent_rank"), "cd": Running("cume_dist")},
    )
    return out.select(
        "event_id", "rn", "rk", "drk", F.round("prk", 8).alias("prk"), F.round("cd", 8).alias("cd"), "tile", "first_value",
        F.col("running").cast("double").alias("running"),
    )


@query(
    "window_shift",
    """
    SELECT event_id, lag(value, 2) OVER w AS back, lead(value) OVER w AS ahead, nth_value(value, 2) OVER (w ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS second,
      last_value(value) OVER (w ROWS BETWEEN 1 PRECEDING AND 4 FOLLOWING) AS late
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def window_shift(t: Tables) -> DataFrame:
    def frame(w, a, b):
        return w.rowsBetween(a, b)

    out = sliding(
        t("events").select("event_id", "user_id", "ts", "value"),
        ["user_id"],
        [("ts", True), ("event_id", True)],
        {
            "back": lambda w: F.lag("value", 2).over(w),
            "ahead": lambda w: F.lead("value", 1).over(w),
            "second": lambda w: F.nth_value("value", 2).over(frame(w, -3, 3)),
            "late": lambda w: F.last("value").over(frame(w, -1, 4)),
        },
        before=3,
        after=4,
    )
    return out.select("event_id", "back", "ahead", "second", "late")


@query(
    "window_range_frame",
    """
    WITH d AS (SELECT o_orderstatus, o_orderdate, sum(o_totalprice::DECIMAL(18,2)) AS v FROM orders GROUP BY 1, 2)
    SELECT o_orderstatus, o_orderdate, (sum(v) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate
      RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW))::DOUBLE AS week FROM d
    """,
)
def window_range_frame(t: Tables) -> DataFrame:
    """Rows are first summed per day, so a key's window is bounded by the calendar."""
    d = t("orders").groupBy("o_orderstatus", "o_orderdate").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    w = Window.partitionBy("o_orderstatus").orderBy(day).rangeBetween(-7, 0)
    return d.select("o_orderstatus", "o_orderdate", F.sum("v").over(w).cast("double").alias("week"))


@query("sort_global", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_global(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@query("union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Tables) -> DataFrame:
    a = t("customer").select(F.col("c_nationkey").alias("nation"))
    return a.unionByName(t("supplier").select(F.col("s_nationkey").alias("nation"))).distinct()


@query("union_all", "SELECT 'c' AS side, c_acctbal AS balance FROM customer UNION ALL SELECT 's', s_acctbal FROM supplier")
def union_all(t: Tables) -> DataFrame:
    a = t("customer").select(F.lit("c").alias("side"), F.col("c_acctbal").alias("balance"))
    return a.unionByName(t("supplier").select(F.lit("s").alias("side"), F.col("s_acctbal").alias("balance")))


@query("intersect", "SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT p_partkey FROM part WHERE p_size > 25")
def intersect(t: Tables) -> DataFrame:
    a = t("lineitem").filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("k"))
    return a.intersect(t("part").filter("p_size > 25").select(F.col("p_partkey").alias("k")))


@query("except_all", "SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer")
def except_all(t: Tables) -> DataFrame:
    a = t("orders").select(F.col("o_custkey").alias("k"))
    return a.exceptAll(t("customer").select(F.col("c_custkey").alias("k")))


@query("sample_uniform")
def sample_uniform(t: Tables) -> DataFrame:
    return t("lineitem").select("l_orderkey", "l_linenumber").sample(fraction=0.1, seed=7)


@query("sample_stratified")
def sample_stratified(t: Tables) -> DataFrame:
    return t("orders").sampleBy("o_orderstatus", {"F": 0.1, "O": 0.5, "P": 1.0}, seed=7)


@query("sample_take", "SELECT 100::BIGINT AS taken, 100::BIGINT AS different, 0::BIGINT AS unknown")
def sample_take(t: Tables) -> DataFrame:
    """The rows drawn depend on the seed; compared are their number and that each is another row of the table."""
    return _drawn(rel.take_sample(t("orders").select("o_orderkey", "o_totalprice"), 100, seed=7), t("orders"))


@query("sample_take_replaced", "SELECT 100::BIGINT AS taken, 0::BIGINT AS unknown")
def sample_take_replaced(t: Tables) -> DataFrame:
    return _drawn(rel.take_sample_replaced(t("orders").select("o_orderkey"), "o_orderkey", 100, seed=7), t("orders")).drop("different")


def _drawn(sample: DataFrame, orders: DataFrame) -> DataFrame:
    rows = sample.select("o_orderkey")
    strange = rows.join(orders.select("o_orderkey"), "o_orderkey", "left_anti").agg(F.count(F.lit(1)).alias("unknown"))
    return rows.agg(F.count(F.lit(1)).alias("taken"), F.count_distinct("o_orderkey").alias("different")).withColumn("unknown", strange.scalar())


@query(
    "typed_columns",
    """
    SELECT event_id::VARCHAR AS id, ts::DATE AS day, epoch_us(ts) // 1000000 AS seconds,
      make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS at, substr(event_type, 1, 3) AS kind, json_extract(props, '$.k')::INTEGER AS k
    FROM events
    """,
)
def typed_columns(t: Tables) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    return t("events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").cast("date").alias("day"),
        seconds.alias("seconds"),
        F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("at"),
        F.substring("event_type", 1, 3).alias("kind"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "value",
    ).drop("value")


@query(
    "window_rank_grouped",
    """
    WITH m AS (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, o_orderpriority, count(*)::BIGINT AS n FROM orders GROUP BY 1, 2)
    SELECT month, o_orderpriority, n, row_number() OVER (PARTITION BY month ORDER BY n DESC, o_orderpriority) AS place FROM m
    """,
)
def monthly_ranks(t: Tables) -> DataFrame:
    m = t("orders").groupBy(bucket(F.col("o_orderdate"), "P1M").alias("month"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("month").orderBy(F.col("n").desc(), "o_orderpriority")
    return m.withColumn("place", F.row_number().over(w))
