"""Scalar expressions and user-defined functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import userfunctions as uf
from ..session import materialise
from .registry import Tables, query
from .requests import rounded


@query(
    "expr_arith",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge, -l_linenumber AS neg,
      (l_orderkey % 7)::BIGINT AS modulo, l_quantity ** 2 AS squared,
      l_extendedprice / nullif(l_discount, 0) AS per_discount FROM lineitem
    """,
)
def expr_arith(t: Tables) -> DataFrame:
    c = F.col
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (c("l_extendedprice") * (1 - c("l_discount")) * (1 + c("l_tax"))).alias("charge"),
        (-c("l_linenumber")).alias("neg"),
        (c("l_orderkey") % 7).alias("modulo"),
        (c("l_quantity") ** 2).alias("squared"),
        F.try_divide(c("l_extendedprice"), c("l_discount")).alias("per_discount"),
    )


@query(
    "expr_compare",
    """
    SELECT o_orderkey, o_totalprice = 1000 AS eq, o_totalprice <> 1000 AS ne, o_totalprice >= 200000 AS ge,
      nullif(o_orderstatus, 'F') IS NOT DISTINCT FROM NULL AS same, o_totalprice BETWEEN 100000 AND 200000 AS mid,
      o_orderpriority IN ('1-URGENT', '2-HIGH') AS hot FROM orders
    """,
)
def expr_compare(t: Tables) -> DataFrame:
    p = F.col("o_totalprice")
    return t("orders").select(
        "o_orderkey", (p == 1000).alias("eq"), (p != 1000).alias("ne"), (p >= 200000).alias("ge"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).eqNullSafe(F.lit(None)).alias("same"),
        p.between(100000, 200000).alias("mid"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("hot"),
    )


@query(
    "expr_logic_bits",
    """
    SELECT event_id, (value > 50 AND event_type = 'view') AS both, (value > 50 OR event_type = 'view') AS either, NOT (value > 50) AS neither,
      event_id & 12 AS b_and, event_id | 3 AS b_or, xor(event_id, 5) AS b_xor FROM events
    """,
)
def expr_logic_bits(t: Tables) -> DataFrame:
    big, view, i = F.col("value") > 50, F.col("event_type") == "view", F.col("event_id")
    return t("events").select(
        "event_id", (big & view).alias("both"), (big | view).alias("either"), (~big).alias("neither"),
        i.bitwiseAND(F.lit(12)).alias("b_and"), i.bitwiseOR(F.lit(3)).alias("b_or"), i.bitwiseXOR(F.lit(5)).alias("b_xor"),
    )


@query(
    "expr_case",
    """
    SELECT o_orderstatus, sum(CASE WHEN o_totalprice > 250000 THEN 1 WHEN o_totalprice > 100000 THEN 2 ELSE 0 END)::BIGINT AS score
    FROM orders GROUP BY 1
    """,
)
def expr_case(t: Tables) -> DataFrame:
    p = F.col("o_totalprice")
    return t("orders").groupBy("o_orderstatus").agg(
        F.sum(F.when(p > 250000, 1).when(p > 100000, 2).otherwise(0)).alias("score")
    )


@query(
    "expr_string",
    """
    SELECT c_custkey, substr(c_name, 10, 5) AS part, c_name LIKE '%1%' AS has_one, string_split(c_name, '#')[2] AS tail,
      c_mktsegment || '-' || c_nationkey AS joined, regexp_replace(c_name, '0+', 'z', 'g') AS squeezed, upper(substr(c_mktsegment, 1, 2)) AS head,
      length(c_name)::INTEGER AS len FROM customer
    """,
)
def expr_string(t: Tables) -> DataFrame:
    n = F.col("c_name")
    return t("customer").select(
        "c_custkey", n.substr(10, 5).alias("part"), n.contains("1").alias("has_one"), F.split(n, "#")[1].alias("tail"),
        F.concat(F.col("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string")).alias("joined"),
        F.regexp_replace(n, "0+", "z").alias("squeezed"), F.upper(F.substring("c_mktsegment", 1, 2)).alias("head"),
        F.length(n).alias("len"),
    )


@query(
    "expr_date",
    """
    SELECT o_orderkey, date_trunc('quarter', o_orderdate)::TIMESTAMP AS quarter, o_orderdate + INTERVAL 45 DAY AS later,
      o_orderdate - INTERVAL 3 MONTH AS earlier, last_day(o_orderdate) AS month_end,
      (date_trunc('week', o_orderdate) + INTERVAL 6 DAY)::DATE AS week_end,
      make_date(year(o_orderdate), 12, 31) AS year_end, year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m,
      day(o_orderdate)::INTEGER AS d, dayofyear(o_orderdate)::INTEGER AS doy FROM orders
    """,
)
def expr_date(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t("orders").select(
        "o_orderkey",
        F.date_trunc("quarter", d).cast("timestamp_ntz").alias("quarter"),
        F.timestamp_add("DAY", F.lit(45), d).alias("later"),
        F.timestamp_add("MONTH", F.lit(-3), d).alias("earlier"),
        F.last_day(d).alias("month_end"),
        F.date_add(F.trunc(d.cast("date"), "week"), 6).alias("week_end"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("year_end"),
        F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("d"), F.dayofyear(d).alias("doy"),
    )


@query(
    "expr_nested",
    """
    SELECT event_id, event_type AS field, user_id AS item, value AS entry FROM events
    """,
)
def expr_nested(t: Tables) -> DataFrame:
    nested = t("events").select(
        "event_id", F.struct(F.col("event_type").alias("kind")).alias("s"), F.array(F.lit(0).cast("long"), F.col("user_id")).alias("a"),
        F.create_map(F.lit("v"), F.col("value")).alias("m"),
    )
    return nested.select(
        "event_id", F.col("s").getField("kind").alias("field"), F.col("a").getItem(1).alias("item"), F.col("m").getItem("v").alias("entry")
    )


@query(
    "expr_json",
    """
    SELECT event_id, json_extract(props, '$.k')::INTEGER AS k, '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS text FROM events
    """,
)
def expr_json(t: Tables) -> DataFrame:
    return t("events").select(
        "event_id", F.from_json("props", "k int").getField("k").alias("k"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("text"),
    )


@query(
    "expr_array",
    """
    SELECT vec_id, len(embedding)::INTEGER AS size, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 4) AS squares,
      round(embedding[1]::DOUBLE, 6) AS first FROM embeddings
    """,
)
def expr_array(t: Tables) -> DataFrame:
    e = F.col("embedding")
    squares = F.aggregate(F.transform(e, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return t("embeddings").select(
        "vec_id", F.size(e).alias("size"), F.round(squares, 4).alias("squares"), F.round(e[0].cast("double"), 6).alias("first")
    )


@query(
    "expr_explode",
    "SELECT p_type, unnest(list_sort(list_distinct(list(p_brand)))) AS p_brand FROM part GROUP BY 1",
)
def expr_explode(t: Tables) -> DataFrame:
    return t("part").select("p_type", "p_brand").distinct()


@query(
    "expr_cast",
    """
    SELECT event_id, value::INTEGER::VARCHAR AS as_text, try_cast(event_type AS INTEGER) AS no_number, try_cast(user_id::VARCHAR AS BIGINT) AS number,
      value::DECIMAL(10,1)::DOUBLE AS one_digit FROM (SELECT *, value FROM (SELECT event_id, user_id, event_type, floor(value) AS value FROM events))
    """,
)
def expr_cast(t: Tables) -> DataFrame:
    v = F.floor("value")
    return t("events").select(
        "event_id", v.cast("int").cast("string").alias("as_text"), F.col("event_type").try_cast("int").alias("no_number"),
        F.col("user_id").cast("string").try_cast("long").alias("number"), v.cast("decimal(10,1)").cast("double").alias("one_digit"),
    )


# --- user-defined functions ------------------------------------------------


@query("udf_scalar", "SELECT c_custkey, true AS well_formed, 1::BIGINT AS owners FROM customer")
def udf_scalar(t: Tables) -> DataFrame:
    """Identifiers are random, so what is compared is their form and that no two rows share one."""
    made = materialise(uf.with_uuid(t("customer").select("c_custkey"), "id"), "identifiers")
    owners = made.groupBy("id").agg(F.count(F.lit(1)).alias("owners"))
    return made.join(owners, "id").select("c_custkey", F.col("id").rlike("^[0-9a-f]{32}$").alias("well_formed"), "owners")


@query("udf_pandas_scalar", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * l_quantity AS squared FROM lineitem")
def udf_pandas_scalar(t: Tables) -> DataFrame:
    @F.pandas_udf("double")
    def multiply(a: pd.Series, b: pd.Series) -> pd.Series:
        return a * b

    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", multiply("l_quantity", "l_quantity").alias("squared")
    )


@query(
    "udf_grouped_map",
    "SELECT event_id, round(value - avg(value) OVER (PARTITION BY event_type), 8) AS centred FROM events",
)
def udf_grouped_map(t: Tables) -> DataFrame:
    """Subtract the group mean: an aggregate joined back, so no group is gathered."""
    out = uf.subtract_group_mean(t("events"), ["event_type"], "value", "centred")
    return out.select("event_id", F.round("centred", 8).alias("centred"))


@query("udf_grouped_agg", "SELECT event_type, user_id, round(avg(value), 8) AS mean FROM events GROUP BY 1, 2")
def udf_grouped_agg(t: Tables) -> DataFrame:
    return rounded(uf.udaf_mean(t("events"), ["event_type", "user_id"], "value", "mean"), 8)


@query(
    "udf_window",
    """
    SELECT event_id, event_type, round(avg(value) OVER w, 8) AS mean, round(max(value) OVER w - min(value) OVER w, 8) AS spread
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 2 FOLLOWING)
    """,
)
def udf_window(t: Tables) -> DataFrame:
    """Vectorised functions as window functions, over eight rows around each."""
    def mean(frames: np.ndarray) -> np.ndarray:
        return np.nanmean(frames, axis=1)

    def spread(frames: np.ndarray) -> np.ndarray:
        return np.nanmax(frames, axis=1) - np.nanmin(frames, axis=1)

    src, order = t("events").select("event_id", "event_type", "ts", "value"), [("ts", True), ("event_id", True)]
    means = uf.window_function(src, ["event_type"], order, "value", "mean", mean, 5, 2)
    both = uf.window_function(means, ["event_type"], order, "value", "spread", spread, 5, 2)
    return both.select("event_id", "event_type", F.round("mean", 8).alias("mean"), F.round("spread", 8).alias("spread"))


@query("udaf_average", "SELECT c_mktsegment, round(avg(c_acctbal), 8) AS average FROM customer GROUP BY 1")
def udaf_average(t: Tables) -> DataFrame:
    return rounded(uf.two_phase_average(t("customer"), ["c_mktsegment"], "c_acctbal", "average"), 8)


@query("udf_registry", "SELECT c_custkey, length(c_name)::BIGINT AS n FROM customer")
def udf_registry(t: Tables) -> DataFrame:
    uf.register_text_length(t.spark, "marl_text_length")
    return t.spark.sql("SELECT c_custkey, marl_text_length(c_name) AS n FROM {c}", c=t("customer"))


@query("arrow_exchange", "SELECT n_nationkey, upper(n_name) AS name FROM nation")
def arrow_exchange(t: Tables) -> DataFrame:
    """Arrow batches to pandas and back, inside the tasks."""
    def shout(batches):
        for pdf in batches:
            yield pdf.assign(name=pdf["n_name"].str.upper())[["n_nationkey", "name"]]

    return t("nation").mapInPandas(shout, "n_nationkey int, name string")
