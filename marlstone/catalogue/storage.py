"""Scans, sinks, tables and the bronze-to-silver job.

Each query writes what it needs from the given tables into a fresh folder of
the shared storage and returns what is read back.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files, synthetic
from .registry import Tables, query
from .requests import rounded


def _table(label: str) -> str:
    return f"marl_{label}_{uuid4().hex[:12]}"


def _bronze(t: Tables) -> DataFrame:
    """Station-like snapshots: one per order line, with a nested position."""
    text = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    return t("lineitem").select(
        F.col("l_quantity").cast("long").alias("capacity"),
        text.alias("duedate"),
        F.col("l_linenumber").cast("long").alias("numbikesavailable"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"),
                 F.lit("-"), F.col("l_linenumber").cast("string")).alias("stationcode"),
        F.col("l_returnflag").alias("code_insee_commune"),
        F.col("l_linestatus").alias("nom_arrondissement"),
        F.struct((F.col("l_suppkey") % 90).cast("double").alias("lat"), (F.col("l_partkey") % 180).cast("double").alias("lon")).alias(
            "coordonnees_geo"
        ),
    )


_STATIONS = """
    l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS stationcode
"""


@query(
    "scan_json_nested",
    f"SELECT {_STATIONS}, l_quantity::BIGINT AS capacity, (l_suppkey % 90)::DOUBLE AS lat, (l_partkey % 180)::DOUBLE AS lon FROM lineitem",
)
def scan_json_nested(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    _bronze(t).write.json(path)
    return files.scan_json(t.spark, path).select("stationcode", "capacity", *files.point_columns("coordonnees_geo"))


@query("scan_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def scan_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    src = t("orders").drop("o_orderdate")
    src.write.option("header", True).option("sep", ";").csv(path)
    return files.scan_csv(t.spark, path, ";", src.schema)


@query("scan_csv_inferred", "SELECT c_custkey::INTEGER AS c_custkey, c_name, c_acctbal FROM customer")
def scan_csv_inferred(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    t("customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(path)
    return files.scan_csv(t.spark, path, infer=True)


@query(
    "scan_text_filter_count",
    """
    WITH l AS (SELECT unnest(string_split(replace(text, chr(13), chr(10)), chr(10))) AS line FROM documents)
    SELECT 'a' AS token, count(*) FILTER (WHERE contains(line, 'a'))::BIGINT AS lines FROM l
    UNION ALL SELECT 'b', count(*) FILTER (WHERE contains(line, 'b')) FROM l
    """,
)
def scan_text_filter_count(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "text")
    t("documents").select("text").write.text(path)
    return files.count_lines_with(t.spark.read.text(path), ["a", "b"])


@query(
    "scan_parquet_merge_schema",
    """
    SELECT o_orderkey, o_totalprice AS price, NULL::VARCHAR AS status, 1::INTEGER AS key FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, NULL, o_orderstatus, 2 FROM orders WHERE o_orderkey % 2 = 1
    """,
)
def scan_parquet_merge_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "merge")
    even, odd = t("orders").filter("o_orderkey % 2 = 0"), t("orders").filter("o_orderkey % 2 = 1")
    even.select("o_orderkey", F.col("o_totalprice").alias("price")).write.parquet(f"{path}/key=1")
    odd.select("o_orderkey", F.col("o_orderstatus").alias("status")).write.parquet(f"{path}/key=2")
    return files.scan_merged(t.spark, path).select("o_orderkey", "price", "status", "key")


@query("scan_orc", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_orc(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orc")
    t("supplier").write.orc(path)
    return t.spark.read.orc(path)


@query("sql_on_file", "SELECT p_partkey, p_name FROM part")
def sql_on_file(t: Tables) -> DataFrame:
    return files.sql_on_file(t.spark, t.path("part"), ["p_partkey", "p_name"])


@query("json_from_strings", "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_from_strings(t: Tables) -> DataFrame:
    return files.json_columns(t("events"), "props", "k bigint", ["event_id"])


@query(
    "upload_csv",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus, round(o_totalprice, 2) AS price, "
    "o_orderdate AS day FROM orders",
)
def upload_csv(t: Tables) -> DataFrame:
    path, table = scratch_path(t.spark, "upload"), _table("upload")
    src = t("orders").select(
        "o_orderkey", "o_orderstatus",
        F.regexp_replace(F.expr("format_number(o_totalprice, '0.00')"), r"\.", ",").alias("price"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"), F.lit("x").alias("unused"),
    )
    src.write.option("header", True).option("sep", ";").csv(path)
    files.upload_csv(
        t.spark, path, table, location=scratch_path(t.spark, "table"), sep=";", decimal=",", null_values=["P"], day_first=True,
        use_columns=["o_orderkey", "o_orderstatus", "price", "day"], types={"o_orderkey": "bigint", "price": "double"}, dates=["day"],
    )
    return t.spark.table(table)


@query("upload_parquet", "SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def upload_parquet(t: Tables) -> DataFrame:
    paths = [scratch_path(t.spark, "part"), scratch_path(t.spark, "part")]
    t("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_acctbal").write.parquet(paths[0])
    t("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")).write.parquet(paths[1])
    return files.read_parquet_upload(t.spark, paths, ["key", "name"])


@query("dataframe_to_table", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def dataframe_to_table(t: Tables) -> DataFrame:
    table, place = _table("frame"), scratch_path(t.spark, "frame")
    src = t("nation").select("n_nationkey", "n_name")
    files.store_table(src, table, "fail", place)
    files.store_table(src, table, "replace", place)
    files.store_table(src, table, "append", place)
    return t.spark.table(table)


@query("synthetic_table")
def synthetic_table(t: Tables) -> DataFrame:
    return synthetic.synthetic_columns(t("customer").select("c_custkey"), "c_custkey", synthetic.wide_columns(14), seed=11)


@query("random_distribution")
def random_distribution(t: Tables) -> DataFrame:
    key = F.col("l_orderkey") * 1000 + F.col("l_partkey") * 7 + F.col("l_linenumber")
    return t("lineitem").select(
        "l_orderkey", "l_linenumber",
        synthetic.uniform(key, 1).alias("uniform"), synthetic.normal(key, 2).alias("normal"),
        synthetic.log_normal(key, 3, 2.0, 0.5).alias("log_normal"), synthetic.exponential(key, 4, 3.0).alias("exponential"),
        synthetic.poisson(key, 5, 4.0).alias("poisson"), synthetic.gamma(key, 6, 2.5, 2.0).alias("gamma"),
    )


# --- sinks and tables ------------------------------------------------------


@query(
    "sink_partitioned_parquet",
    "SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS year FROM orders",
)
def sink_partitioned_parquet(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "partitioned")
    src = t("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    files.write_partitioned(src, path, ["year"], files=2)
    return t.spark.read.parquet(path)


@query(
    "sink_partition_overwrite",
    "SELECT o_orderkey, CASE WHEN year(o_orderdate) = 2000 THEN 0.0 ELSE o_totalprice END AS price, year(o_orderdate)::INTEGER AS year FROM orders",
)
def sink_partition_overwrite(t: Tables) -> DataFrame:
    """Only the rewritten year changes."""
    path = scratch_path(t.spark, "dynamic")
    src = t("orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.year("o_orderdate").alias("year"))
    files.write_partitioned(src, path, ["year"])
    files.write_partitioned(src.filter("year = 2000").withColumn("price", F.lit(0.0)), path, ["year"], dynamic=True)
    return t.spark.read.parquet(path)


@query("sink_csv_single", "SELECT c_mktsegment, count(*)::BIGINT AS n FROM customer GROUP BY 1")
def sink_csv_single(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "single")
    files.write_single_csv(t("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), path)
    return files.scan_csv(t.spark, path, schema="c_mktsegment string, n bigint")


@query("sink_orc_options", "SELECT p_partkey, p_brand, p_size FROM part")
def sink_orc_options(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orc")
    files.write_orc(t("part").select("p_partkey", "p_brand", "p_size"), path, ["p_brand"])
    return t.spark.read.orc(path)


@query(
    "sink_bucketed",
    "SELECT o_orderstatus, count(*)::BIGINT AS n, round(sum(l_quantity), 2) AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
)
def sink_bucketed(t: Tables) -> DataFrame:
    """Both sides bucketed on the join key: the join needs no exchange."""
    left, right = _table("lines"), _table("orders")
    files.write_bucketed(t("lineitem").select("l_orderkey", "l_quantity"), left, 8, "l_orderkey", "l_orderkey", scratch_path(t.spark, "b"))
    files.write_bucketed(t("orders").select("o_orderkey", "o_orderstatus"), right, 8, "o_orderkey", "o_orderkey", scratch_path(t.spark, "b"))
    joined = t.spark.table(left).join(t.spark.table(right).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rounded(joined.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty")), 2)


@query(
    "external_table",
    "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y') AS part_year FROM orders",
)
def external_table(t: Tables) -> DataFrame:
    """Partitions of an external table appear once they are synchronised."""
    path, table = scratch_path(t.spark, "external"), f"marl_silver.{_table('external')}"
    src = t("orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("part_year"))
    files.write_partitioned(src, path, ["part_year"])
    files.create_external(t.spark, table, src.schema, ["part_year"], path)
    files.sync_partitions(t.spark, table)
    return t.spark.table(table)


@query("ctas", "SELECT c_nationkey, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1")
def ctas(t: Tables) -> DataFrame:
    sums = rounded(t("customer").groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("balance")), 2)
    name = files.temporary_name("marl", uuid4().hex[:12])
    return files.create_as(sums, name, scratch_path(t.spark, "ctas"), "orc")


@query(
    "latest_partition",
    "SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS year FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
)
def latest_partition(t: Tables) -> DataFrame:
    path, table = scratch_path(t.spark, "latest"), f"marl_silver.{_table('latest')}"
    src = t("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    files.write_partitioned(src, path, ["year"])
    files.create_external(t.spark, table, src.schema, ["year"], path)
    files.sync_partitions(t.spark, table)
    return files.at_latest_partition(t.spark, table)


@query(
    "export_csv_escaped",
    """
    WITH s AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '=cmd|' || event_type WHEN 1 THEN '-12.5' WHEN 2 THEN '  +x' WHEN 3 THEN '""@y'
                 WHEN 4 THEN event_type ELSE '-a' END AS v FROM events)
    SELECT event_id, CASE WHEN regexp_matches(v, '^(""|\\s+)?[-@+|=%]') AND NOT regexp_matches(v, '^-[0-9.]+$')
      THEN '''' || replace(v, '|', '\\|') ELSE v END AS "'=v" FROM s
    """,
)
def export_csv_escaped(t: Tables) -> DataFrame:
    kind = F.col("event_id") % 6
    v = (
        F.when(kind == 0, F.concat(F.lit("=cmd|"), "event_type")).when(kind == 1, F.lit("-12.5")).when(kind == 2, F.lit("  +x"))
        .when(kind == 3, F.lit('""@y')).when(kind == 4, F.col("event_type")).otherwise(F.lit("-a"))
    )
    return files.escaped_csv(t("events").select("event_id", v.alias("=v")))


@query("catalog_ops")
def catalog_ops(t: Tables) -> DataFrame:
    """Tables, caching and columns through the catalogue."""
    name = _table("view")
    t("customer").createOrReplaceTempView(name)
    catalog = t.spark.catalog
    catalog.cacheTable(name)
    cached = catalog.isCached(name)
    catalog.uncacheTable(name)
    catalog.refreshTable(name)
    rows = [(c.name, c.dataType, catalog.tableExists(name), cached) for c in catalog.listColumns(name)]
    catalog.dropTempView(name)
    return t.spark.createDataFrame(rows, "column string, type string, exists boolean, was_cached boolean")


@query("temp_views", "SELECT count(*)::BIGINT AS n FROM supplier WHERE s_acctbal > 0")
def temp_views(t: Tables) -> DataFrame:
    name = _table("global")
    t("supplier").createOrReplaceGlobalTempView(name)
    return t.spark.newSession().sql(f"SELECT count(*) AS n FROM global_temp.{name} WHERE s_acctbal > 0")


@query(
    "managed_table_dml",
    "SELECT r_regionkey::VARCHAR AS value, r_name AS key FROM region UNION ALL SELECT 'again', r_name FROM region WHERE r_regionkey > 2",
)
def managed_table_dml(t: Tables) -> DataFrame:
    name, place = _table("managed"), scratch_path(t.spark, "managed")
    t.spark.sql(f"CREATE TABLE {name} (value STRING, key STRING) USING parquet PARTITIONED BY (key) LOCATION '{place}'")
    insert = f"INSERT INTO {name} SELECT CAST(r_regionkey AS STRING), r_name FROM {{r}}"
    t.spark.sql(insert, r=t("region"))
    t.spark.sql(f"INSERT INTO {name} SELECT 'again', r_name FROM {{r}} WHERE r_regionkey > 2", r=t("region"))
    return t.spark.table(name)


@query(
    "silver_transform",
    f"""
    SELECT {_STATIONS}, l_quantity::BIGINT AS capacity, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS duedate, l_linenumber::BIGINT AS numbikesavailable,
      round(l_linenumber / l_quantity, 8) AS fill_ratio, strftime(l_shipdate, '%Y-%m-%d') AS part_day,
      strftime(l_shipdate, '%Y-%m-%dT%H:%M') AS part_minute, (l_suppkey % 90)::DOUBLE AS lat, (l_partkey % 180)::DOUBLE AS lon
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'
    """,
)
def silver_transform(t: Tables) -> DataFrame:
    return rounded(files.silver(_bronze(t), "1996-01-01"), 8)
