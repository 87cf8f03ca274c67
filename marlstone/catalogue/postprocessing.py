"""Post-processing operators on result frames and on raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geohash as geo
from ..functions.grains import bucket
from ..operators import postprocess as pp
from ..operators.forecast import forecast
from ..operators.pivots import pivot
from .registry import Tables, query


def monthly(t: Tables) -> DataFrame:
    """Revenue and lines per month and return flag."""
    return (
        t("lineitem")
        .groupBy(bucket(F.col("l_shipdate"), "P1M").alias("month"), F.col("l_returnflag").alias("flag"))
        .agg(
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
            F.sum("l_quantity").alias("qty"),
            F.count(F.lit(1)).alias("n"),
        )
    )


MONTHLY = """
    WITH m AS (SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS month, l_returnflag AS flag,
               sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price, sum(l_quantity) AS qty, count(*)::BIGINT AS n
               FROM lineitem GROUP BY 1, 2)
"""

DAILY = """
    WITH d AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type AS kind, sum(value::DECIMAL(18,2))::DOUBLE AS v
               FROM events GROUP BY 1, 2)
"""


def daily(t: Tables) -> DataFrame:
    """Value per day and event type; a finer grid finds gaps between the days."""
    return t("events").groupBy(bucket(F.col("ts"), "P1D").alias("day"), F.col("event_type").alias("kind")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("v")
    )


@query(
    "aggregate",
    """
    WITH e AS (SELECT event_type AS kind, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS v, event_id FROM events),
    p AS (SELECT kind, v, row_number() OVER (PARTITION BY kind ORDER BY event_id) - 1 AS i FROM e)
    SELECT kind, round(avg(v), 6) AS mean, CASE WHEN count(v) = count(*) THEN avg(v) END AS average,
      count(*)::BIGINT AS rows, count(*) FILTER (WHERE v <> 0 OR v IS NULL)::BIGINT AS nonzero,
      max(v) AS high, min(v) AS low, round(quantile_cont(v, 0.5), 6) AS nanmedian,
      CASE WHEN count(v) = count(*) THEN quantile_cont(v, 0.5) END AS median,
      round(quantile_cont(v, 0.9), 6) AS p90, round(stddev_pop(v), 6) AS std, round(var_pop(v), 4) AS var,
      round(sum(v), 4) AS total,
      (SELECT min(q.i) FROM p q WHERE q.kind = p.kind AND q.v = min(p.v))::BIGINT AS first_min,
      (SELECT min(q.i) FROM p q WHERE q.kind = p.kind AND q.v = max(p.v))::BIGINT AS first_max
    FROM p GROUP BY kind
    """,
)
def aggregate(t: Tables) -> DataFrame:
    e = t("events").select(
        F.col("event_type").alias("kind"), F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("v"), "event_id"
    )
    spec = {
        "mean": "mean", "average": "average", "rows": "count", "nonzero": "count_nonzero", "high": "max", "low": "min",
        "nanmedian": "nanmedian", "median": "median", "p90": "nanpercentile", "std": "std", "var": "var", "total": "sum",
        "first_min": "argmin", "first_max": "argmax",
    }
    aggregates = {k: {"column": "v", "operator": o} for k, o in spec.items()}
    aggregates["p90"]["options"] = {"q": 90}
    out = pp.aggregate(e, ["kind"], aggregates, order="event_id")
    digits = {"mean": 6, "nanmedian": 6, "p90": 6, "std": 6, "var": 4, "total": 4}
    return out.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in out.columns])


@query(
    "boxplot",
    """
    WITH r AS (SELECT o_orderpriority AS g, o_totalprice AS v,
                 row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i,
                 count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
    q AS (SELECT g, avg(v) AS mean, count(*)::BIGINT AS n,
            (max(v) FILTER (WHERE i = floor(0.25 * (n - 1))) + max(v) FILTER (WHERE i = ceil(0.25 * (n - 1)))) / 2 AS q1,
            (max(v) FILTER (WHERE i = floor(0.5 * (n - 1))) + max(v) FILTER (WHERE i = ceil(0.5 * (n - 1)))) / 2 AS q2,
            (max(v) FILTER (WHERE i = floor(0.75 * (n - 1))) + max(v) FILTER (WHERE i = ceil(0.75 * (n - 1)))) / 2 AS q3
          FROM r GROUP BY g)
    SELECT q.g AS o_orderpriority, round(any_value(mean), 4) AS price__mean, round(any_value(q2), 4) AS price__median,
      max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)) AS price__max, min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)) AS price__min,
      round(any_value(q1), 4) AS price__q1, round(any_value(q3), 4) AS price__q3, count(*)::BIGINT AS price__count,
      count(*) FILTER (WHERE v > q3 + 1.5 * (q3 - q1) OR v < q1 - 1.5 * (q3 - q1))::BIGINT AS price__outliers
    FROM q JOIN r ON q.g = r.g GROUP BY q.g
    """,
)
def boxplot(t: Tables) -> DataFrame:
    src = t("orders").withColumnRenamed("o_totalprice", "price")
    out = pp.boxplot(src, ["o_orderpriority"], ["price"], outliers="count")
    return out.select(
        *[F.round(c, 4).alias(c) if c in ("price__mean", "price__median", "price__q1", "price__q3") else F.col(c) for c in out.columns]
    )


@query(
    "boxplot_outliers",
    """
    WITH q AS (SELECT event_type AS kind, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM events GROUP BY 1)
    SELECT kind, value FROM events JOIN q ON kind = event_type WHERE value < lo OR value > hi
    """,
)
def boxplot_outliers(t: Tables) -> DataFrame:
    src = t("events").withColumnRenamed("event_type", "kind")
    return pp.boxplot_outliers(src, ["kind"], "value", "percentile", (5, 95))


@query(
    "compare",
    MONTHLY
    + """
    SELECT month, flag, round(price - qty, 4) AS difference__price__qty, round((price - qty) / qty, 4) AS percentage__price__qty,
      round(price / qty, 4) AS ratio__price__qty FROM m
    """,
)
def compare(t: Tables) -> DataFrame:
    out = monthly(t).drop("n")
    for kind in ("difference", "percentage", "ratio"):
        out = pp.compare(out, ["price"], ["qty"], kind)
    return out.drop("price", "qty")


@query(
    "contribution",
    MONTHLY
    + """
    SELECT month, flag, round(price / sum(price) OVER (), 9) AS price_share, round(qty / (qty + n), 9) AS qty_in_row,
      round(n / (qty + n), 9) AS n_in_row FROM m
    """,
)
def contribution(t: Tables) -> DataFrame:
    out = pp.contribution(monthly(t), "column", ["price"], rename_columns=["price_share"])
    out = pp.contribution(out, "row", ["qty", "n"], rename_columns=["qty_in_row", "n_in_row"])
    return out.select("month", "flag", *[F.round(c, 9).alias(c) for c in ("price_share", "qty_in_row", "n_in_row")])


@query(
    "cum",
    MONTHLY
    + """
    SELECT month, flag, sum(qty) OVER w AS qty_sum, min(qty) OVER w AS qty_min, max(qty) OVER w AS qty_max
    FROM m WINDOW w AS (PARTITION BY flag ORDER BY month)
    """,
)
def cum(t: Tables) -> DataFrame:
    out = monthly(t).select("month", "flag", "qty")
    for op in ("sum", "min", "max"):
        out = pp.cum(out, op, {"qty": f"qty_{op}"}, "month", ["flag"], row_level=False)
    return out.drop("qty")


@query(
    "cum_rows",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, sum(l_quantity) OVER w AS running_qty, max(l_extendedprice) OVER w AS top_price
    FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
                               ROWS UNBOUNDED PRECEDING)
    """,
)
def cum_rows(t: Tables) -> DataFrame:
    """Running values over raw rows: three keys hold the whole table."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    src = t("lineitem").select(*order, "l_returnflag", "l_quantity", "l_extendedprice")
    out = pp.cum(src, "sum", {"l_quantity": "running_qty"}, order, ["l_returnflag"], row_level=True)
    out = pp.cum(out, "max", {"l_extendedprice": "top_price"}, order, ["l_returnflag"], row_level=True)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "running_qty", "top_price")


@query(
    "diff",
    MONTHLY
    + """
    SELECT month, flag, qty - lag(qty, 2) OVER w AS back, qty - lead(qty) OVER w AS ahead, n - qty AS columns
    FROM m WINDOW w AS (PARTITION BY flag ORDER BY month)
    """,
)
def diff(t: Tables) -> DataFrame:
    out = pp.diff(monthly(t), {"qty": "back"}, 2, order="month", keys=["flag"], row_level=False)
    out = pp.diff(out, {"qty": "ahead"}, -1, order="month", keys=["flag"], row_level=False)
    return pp.diff(out, {"qty": "qty", "n": "columns"}, axis="column").select("month", "flag", "back", "ahead", "columns")


@query(
    "flatten",
    """
    SELECT date_trunc('year', o_orderdate)::TIMESTAMP AS year,
      round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS "total, F\\, all",
      round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS "total, O"
    FROM orders GROUP BY 1
    """,
)
def flatten(t: Tables) -> DataFrame:
    wide = (
        t("orders")
        .groupBy(bucket(F.col("o_orderdate"), "P1Y").alias("year"))
        .pivot("o_orderstatus", ["F", "O"])
        .agg(F.round(F.sum("o_totalprice"), 2))
    )
    return pp.flatten(wide, {"F": ["total", "F, all"], "O": ["total", None, "O"]})


@query(
    "pivot",
    """
    SELECT o_orderpriority, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS "total, F",
      round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS "total, O",
      round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2) AS "total, P",
      max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS "top, F",
      max(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS "top, O",
      max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS "top, P"
    FROM orders GROUP BY 1
    """,
)
def pivoted(t: Tables) -> DataFrame:
    spec = {"total": {"column": "o_totalprice", "operator": "sum"}, "top": {"column": "o_totalprice", "operator": "max"}}
    out = pivot(t("orders"), ["o_orderpriority"], spec, ["o_orderstatus"])
    return out.select(*[F.round(F.col(f"`{c}`"), 2).alias(c) if c.startswith("total") else F.col(f"`{c}`") for c in out.columns])


@query(
    "pivot_margins",
    """
    SELECT coalesce(o_orderpriority, 'All') AS o_orderpriority,
      round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS "total, F",
      round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS "total, O",
      round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2) AS "total, P",
      round(sum(o_totalprice), 2) AS "total, All"
    FROM orders GROUP BY ROLLUP (o_orderpriority)
    """,
)
def pivot_margins(t: Tables) -> DataFrame:
    spec = {"total": {"column": "o_totalprice", "operator": "sum"}}
    out = pivot(t("orders"), ["o_orderpriority"], spec, ["o_orderstatus"], marginal_distributions=True)
    return out.select("o_orderpriority", *[F.round(F.col(f"`{c}`"), 2).alias(c) for c in out.columns[1:]])


@query("rename", MONTHLY + "SELECT month AS period, flag AS series, qty FROM m")
def rename(t: Tables) -> DataFrame:
    return pp.rename(monthly(t).select("month", "flag", "qty"), {"month": "period", "flag": "series"})


@query("select", MONTHLY + "SELECT month, qty AS quantity FROM m")
def select(t: Tables) -> DataFrame:
    return pp.select(monthly(t), ["month", "qty", "n"], ["n"], {"qty": "quantity"})


@query("sort", MONTHLY + "SELECT month, flag, qty FROM m ORDER BY qty DESC, month")
def sort(t: Tables) -> DataFrame:
    return pp.sort(monthly(t).select("month", "flag", "qty"), ["qty", "month"], [False, True])


_GRID = """
    , k AS (SELECT DISTINCT kind FROM d),
    g AS (SELECT kind, unnest(generate_series((SELECT min(day) FROM d), (SELECT max(day) FROM d), INTERVAL {step})) AS day FROM k),
    j AS (SELECT g.kind, g.day, d.v FROM g LEFT JOIN d ON d.kind = g.kind AND d.day = g.day)
"""


@query(
    "resample_fill",
    DAILY
    + _GRID.format(step="12 HOUR")
    + """
    SELECT kind, day, v AS asfreq, coalesce(v, 0) AS zero,
      last_value(v IGNORE NULLS) OVER (PARTITION BY kind ORDER BY day) AS ffill,
      first_value(v IGNORE NULLS) OVER (PARTITION BY kind ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bfill
    FROM j
    """,
)
def resample_fill(t: Tables) -> DataFrame:
    d = daily(t)
    parts = [
        pp.resample(d, "day", "12h", "asfreq", ["kind"]).withColumnRenamed("v", "asfreq"),
        pp.resample(d, "day", "12h", "asfreq", ["kind"], fill_value=0).withColumnRenamed("v", "zero"),
        pp.resample(d, "day", "12h", "ffill", ["kind"]).withColumnRenamed("v", "ffill"),
        pp.resample(d, "day", "12h", "bfill", ["kind"]).withColumnRenamed("v", "bfill"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, ["kind", "day"])
    return out.select("kind", "day", "asfreq", "zero", "ffill", "bfill")


@query(
    "resample_linear",
    DAILY
    + _GRID.format(step="6 HOUR")
    + """
    , i AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY day) AS i FROM j),
    f AS (SELECT kind, day, i, v,
       last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS i0, last_value(v IGNORE NULLS) OVER a AS v0,
       first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS i1, first_value(v IGNORE NULLS) OVER b AS v1
      FROM i WINDOW a AS (PARTITION BY kind ORDER BY i),
        b AS (PARTITION BY kind ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT kind, day, round(CASE WHEN v0 IS NULL THEN NULL WHEN v1 IS NULL OR i0 = i1 THEN v0
       ELSE v0 + (v1 - v0) * (i - i0) / (i1 - i0) END, 6) AS v FROM f
    """,
)
def resample_linear(t: Tables) -> DataFrame:
    return pp.resample(daily(t), "day", "6h", "linear", ["kind"]).select("kind", "day", F.round("v", 6).alias("v"))


@query(
    "resample_aggregate",
    """
    WITH k AS (SELECT DISTINCT event_type AS kind FROM events),
    g AS (SELECT kind, unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM events),
            (SELECT date_trunc('hour', max(ts)) FROM events), INTERVAL 1 HOUR)) AS ts FROM k),
    b AS (SELECT event_type AS kind, date_trunc('hour', ts)::TIMESTAMP AS ts, sum(value) AS s, avg(value) AS a,
            quantile_cont(value, 0.5) AS m FROM events GROUP BY 1, 2)
    SELECT g.kind, g.ts, round(coalesce(s, 0), 4) AS total, round(a, 9) AS mean, round(m, 6) AS median
    FROM g LEFT JOIN b ON g.kind = b.kind AND g.ts = b.ts
    """,
)
def resample_aggregate(t: Tables) -> DataFrame:
    src = t("events").select("ts", F.col("event_type").alias("kind"), F.col("value").alias("v"))
    total = pp.resample(src, "ts", "1h", "sum", ["kind"]).select("kind", "ts", F.round("v", 4).alias("total"))
    mean = pp.resample(src, "ts", "1h", "mean", ["kind"]).select("kind", "ts", F.round("v", 9).alias("mean"))
    median = pp.resample(src, "ts", "1h", "median", ["kind"]).select("kind", "ts", F.round("v", 6).alias("median"))
    return total.join(mean, ["kind", "ts"]).join(median, ["kind", "ts"])


@query(
    "rolling",
    MONTHLY
    + """
    , w AS (SELECT month, flag, row_number() OVER (PARTITION BY flag ORDER BY month) AS i,
       sum(qty) OVER r AS qty_sum, avg(qty) OVER r AS qty_mean, min(qty) OVER r AS qty_min, max(qty) OVER r AS qty_max,
       stddev_samp(qty) OVER r AS qty_std, var_samp(qty) OVER r AS qty_var, quantile_cont(qty, 0.5) OVER r AS qty_median,
       quantile_cont(qty, 0.25) OVER r AS qty_q25, count(qty) OVER r AS c
      FROM m WINDOW r AS (PARTITION BY flag ORDER BY month ROWS 5 PRECEDING))
    SELECT month, flag, round(qty_sum, 6) AS qty_sum, round(qty_mean, 6) AS qty_mean, qty_min, qty_max, round(qty_std, 5) AS qty_std,
       round(qty_var, 2) AS qty_var, round(qty_median, 6) AS qty_median, round(qty_q25, 6) AS qty_q25
    FROM w WHERE i >= 6 AND c >= 6
    """,
)
def rolling(t: Tables) -> DataFrame:
    out = monthly(t).select("month", "flag", "qty")
    for kind in ("sum", "mean", "min", "max", "std", "var", "median"):
        out = pp.rolling(out, kind, {"qty": f"qty_{kind}"}, 6, "month", ["flag"], min_periods=1 if kind != "median" else 1, row_level=False)
    out = pp.rolling(out, "quantile", {"qty": "qty_q25"}, 6, "month", ["flag"], rolling_type_options={"quantile": 0.25}, row_level=False)
    digits = {"qty_sum": 6, "qty_mean": 6, "qty_std": 5, "qty_var": 2, "qty_median": 6, "qty_q25": 6}
    return out.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in out.columns if c != "qty"])


@query(
    "rolling_center",
    MONTHLY
    + """
    SELECT month, flag, CASE WHEN count(qty) OVER r >= 1 THEN round(avg(qty) OVER r, 6) END AS mean,
      CASE WHEN isnan(corr(qty, price) OVER r) THEN NULL ELSE round(corr(qty, price) OVER r, 6) END AS corr FROM m
    WINDOW r AS (PARTITION BY flag ORDER BY month ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)
    """,
)
def rolling_center(t: Tables) -> DataFrame:
    out = pp.rolling(monthly(t), "mean", {"qty": "mean"}, 4, "month", ["flag"], 1, center=True, row_level=False)
    out = pp.rolling(out, "corr", {"qty": "corr"}, 4, "month", ["flag"], 1, center=True, other="price", row_level=False)
    return out.select("month", "flag", F.round("mean", 6).alias("mean"), F.round("corr", 6).alias("corr"))


@query(
    "rolling_rows",
    """
    WITH w AS (SELECT event_id, event_type, avg(value) OVER r AS mean, max(value) OVER r AS top,
        row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i
      FROM events WINDOW r AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 9 PRECEDING))
    SELECT event_id, event_type, round(mean, 6) AS mean, top FROM w WHERE i >= 10
    """,
)
def rolling_rows(t: Tables) -> DataFrame:
    """Rolling values over raw rows, block by block."""
    src = t("events").select("event_id", "event_type", "ts", "value")
    out = pp.rolling(src, "mean", {"value": "mean"}, 10, ["ts", "event_id"], ["event_type"], min_periods=1, row_level=True)
    out = pp.rolling(out, "max", {"value": "top"}, 10, ["ts", "event_id"], ["event_type"], row_level=True)
    return out.select("event_id", "event_type", F.round("mean", 6).alias("mean"), "top")


@query("forecast")
def forecast_orders(t: Tables) -> DataFrame:
    m = t("orders").groupBy(bucket(F.col("o_orderdate"), "P1M").alias("__timestamp"), "o_orderstatus").agg(
        F.sum("o_totalprice").alias("total")
    )
    return forecast(m, "P1M", 6, 0.8, yearly_seasonality=3, keys=["o_orderstatus"])


def points(t: Tables) -> DataFrame:
    """A place per event, derived from its numbers."""
    return t("events").select(
        "event_id",
        ((F.col("event_id") * 7919 % 36000) / 100.0 - 180.0).alias("lon"),
        ((F.col("event_id") * 104729 % 17000) / 100.0 - 85.0).alias("lat"),
        "value",
    )


POINTS = """
    WITH p AS (SELECT event_id, (event_id * 7919 % 36000) / 100.0::DOUBLE - 180.0 AS lon,
               (event_id * 104729 % 17000) / 100.0::DOUBLE - 85.0 AS lat, value FROM events)
"""


@query(
    "geohash_encode",
    POINTS
    + """
    , c AS (SELECT event_id, floor((lon + 180) / 360 * 1073741824)::BIGINT AS x, floor((lat + 90) / 180 * 1073741824)::BIGINT AS y FROM p)
    SELECT event_id, array_to_string(list_transform(range(12), lambda k: substr('0123456789bcdefghjkmnpqrstuvwxyz',
      (1 + list_sum(list_transform(range(5), lambda b:
        (CASE WHEN (5 * k + b) % 2 = 0 THEN (x >> (29 - (5 * k + b) // 2)) & 1 ELSE (y >> (29 - (5 * k + b) // 2)) & 1 END)
        << (4 - b))))::BIGINT, 1)), '') AS geohash
    FROM c
    """,
)
def geohash_encode(t: Tables) -> DataFrame:
    return pp.geohash_encode(points(t), "geohash", "lon", "lat").select("event_id", "geohash")


@query(
    "geohash_decode",
    POINTS + "SELECT event_id, round(lon, 4) AS lon, round(lat, 4) AS lat FROM p",
)
def geohash_decode(t: Tables) -> DataFrame:
    """Round trip: the centre of a 12-character cell is the point itself at this precision."""
    coded = points(t).select("event_id", geo.encode(F.col("lat"), F.col("lon")).alias("geohash"))
    out = pp.geohash_decode(coded, "geohash", "lon", "lat")
    return out.select("event_id", F.round("lon", 4).alias("lon"), F.round("lat", 4).alias("lat"))


@query(
    "geodetic_parse",
    POINTS + "SELECT event_id, lat, lon, round(value / 1000, 6) AS alt FROM p",
)
def geodetic_parse(t: Tables) -> DataFrame:
    text = F.concat_ws(", ", F.col("lat").cast("string"), F.col("lon").cast("string"), F.concat(F.col("value").cast("string"), F.lit("m")))
    out = pp.geodetic_parse(points(t).select("event_id", text.alias("text")), "text", "lon", "lat", "alt")
    return out.select("event_id", "lat", "lon", F.round("alt", 6).alias("alt"))
