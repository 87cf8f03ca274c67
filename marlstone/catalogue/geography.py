"""Binning of points."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geohash as geo
from ..operators import geography as gg
from .postprocessing import POINTS, points
from .registry import Tables, query
from .requests import rounded

_CELLS = (
    POINTS
    + f"""
    , c AS (SELECT floor(radians(lon) * {gg.EARTH_RADIUS} / 500000)::BIGINT AS cell_x,
              floor(ln(tan(pi() / 4 + radians(lat) / 2)) * {gg.EARTH_RADIUS} / 500000)::BIGINT AS cell_y, value AS v FROM p)
"""
)


@query(
    "grid_bins",
    _CELLS
    + """
    SELECT cell_x, cell_y, round(sum(v), 4) AS total, round(quantile_cont(v, 0.95), 6) AS p95, round(var_samp(v), 3) AS variance
    FROM c GROUP BY 1, 2
    """,
)
def grid_bins(t: Tables) -> DataFrame:
    out = None
    for how, name, digits in (("sum", "total", 4), ("p95", "p95", 6), ("variance", "variance", 3)):
        part = gg.grid_bins(points(t), "lon", "lat", 500_000, "value", how)
        part = part.select("cell_x", "cell_y", F.round("cell_value", digits).alias(name))
        out = part if out is None else out.join(part, ["cell_x", "cell_y"])
    return out


@query(
    "hex_bins",
    POINTS
    + f"""
    , m AS (SELECT radians(lon) * {gg.EARTH_RADIUS} AS x, ln(tan(pi() / 4 + radians(lat) / 2)) * {gg.EARTH_RADIUS} AS y, value FROM p),
    h AS (SELECT (x * {math.sqrt(3) / 3!r} - y / 3) / 400000 AS q, (y * {2 / 3!r}) / 400000 AS r, value FROM m),
    w AS (SELECT *, round_even(q, 0) AS a, round_even(r, 0) AS b, round_even(-q - r, 0) AS c FROM h),
    d AS (SELECT *, abs(a - q) AS da, abs(b - r) AS db, abs(c + q + r) AS dc FROM w),
    n AS (SELECT (CASE WHEN da > db AND da > dc THEN -b - c ELSE a END)::BIGINT AS hex_q,
      (CASE WHEN da > db AND da > dc THEN b WHEN db > dc THEN -a - c ELSE b END)::BIGINT AS hex_r, value FROM d)
    SELECT hex_q, hex_r, round(avg(value), 6) AS cell_value FROM n GROUP BY 1, 2
    """,
)
def hex_bins(t: Tables) -> DataFrame:
    return gg.hex_bins(points(t), "lon", "lat", 400_000, "value", "mean").withColumn("cell_value", F.round("cell_value", 6))


@query(
    "weight_grid",
    POINTS
    + "SELECT floor(lon / 10)::BIGINT AS cell_x, floor(lat / 10)::BIGINT AS cell_y, round(sum(value), 4) AS weight FROM p GROUP BY 1, 2",
)
def weight_grid(t: Tables) -> DataFrame:
    return rounded(gg.weight_grid(points(t), "lon", "lat", 10.0, "value"))


@query(
    "od_flows",
    """
    SELECT c_nationkey AS origin, s_nationkey AS destination, count(*)::BIGINT AS flow
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
    """,
)
def od_flows(t: Tables) -> DataFrame:
    joined = (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.col("c_nationkey").alias("origin"), F.col("s_nationkey").alias("destination"))
    )
    return gg.od_flows(joined, ["origin"], ["destination"], F.count(F.lit(1)))


@query(
    "bounds",
    POINTS + "SELECT min(lon) AS min_longitude, max(lon) AS max_longitude, min(lat) AS min_latitude, max(lat) AS max_latitude FROM p",
)
def bounds(t: Tables) -> DataFrame:
    return gg.bounds(points(t), "lon", "lat")


@query(
    "point_columns",
    POINTS
    + """SELECT event_id, lat AS struct_lat, lon AS struct_lon, lat AS text_lat, lon AS text_lon,
                round(lat, 3) AS hash_lat, round(lon, 3) AS hash_lon FROM p""",
)
def point_columns(t: Tables) -> DataFrame:
    p = points(t)
    text = F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string"))
    src = p.select(
        "event_id", F.struct("lat", "lon").alias("g"), text.alias("delimited"), geo.encode(F.col("lat"), F.col("lon")).alias("h")
    )
    text_lat, text_lon = gg.delimited_point(F.col("delimited"))
    point = geo.decode(F.col("h"))
    return src.select(
        "event_id",
        F.col("g.lat").alias("struct_lat"),
        F.col("g.lon").alias("struct_lon"),
        text_lat.alias("text_lat"),
        text_lon.alias("text_lon"),
        F.round(point.getField("latitude"), 3).alias("hash_lat"),
        F.round(point.getField("longitude"), 3).alias("hash_lon"),
    )


@query(
    "point_clusters",
    POINTS
    + f"""
    , z AS (SELECT unnest([0, 3, 6])::INTEGER AS zoom, lon, lat, value AS v FROM p),
    c AS (SELECT zoom, floor((lon + 180) / 360 * (1 << zoom))::BIGINT AS tile_x,
       floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / {math.pi!r}) / 2 * (1 << zoom))::BIGINT AS tile_y, v FROM z)
    SELECT zoom, tile_x, tile_y, count(*)::BIGINT AS points, round(sum(v), 4) AS sum, min(v) AS min, max(v) AS max,
      round(avg(v), 6) AS mean, round(var_pop(v), 2) AS variance FROM c GROUP BY 1, 2, 3
    """,
)
def point_clusters(t: Tables) -> DataFrame:
    out = gg.point_clusters(points(t), "lon", "lat", "value", [0, 3, 6])
    return out.select(
        "zoom", "tile_x", "tile_y", "points", F.round("sum", 4).alias("sum"), "min", "max",
        F.round("mean", 6).alias("mean"), (F.round(F.abs("variance"), 2)).alias("variance"),
    )
