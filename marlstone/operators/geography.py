"""Binning of points: square and hexagon cells, tiles, flows, bounds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

EARTH_RADIUS = 6_378_137.0
_QUANTILE = {"median": 0.5, "p1": 0.01, "p5": 0.05, "p95": 0.95, "p99": 0.99}


def to_metres(longitude: Column, latitude: Column) -> tuple[Column, Column]:
    """Web-mercator metres."""
    x = F.radians(longitude) * EARTH_RADIUS
    y = F.log(F.tan(F.lit(math.pi / 4) + F.radians(latitude) / 2)) * EARTH_RADIUS
    return x, y


def _cell_values(df: DataFrame, keys: list[str], value: str, how: str) -> DataFrame:
    v = F.col(f"`{value}`").cast("double")
    if how in _QUANTILE:
        return exact_quantiles(df, keys, value, {"cell_value": _QUANTILE[how]})
    ways = {
        "sum": F.sum(v),
        "min": F.min(v),
        "max": F.max(v),
        "mean": F.avg(v),
        "count": F.count(F.lit(1)),
        "variance": F.var_samp(v),
        "deviation": F.stddev_samp(v),
    }
    if how not in ways:
        raise ValueError(f"unknown cell value {how}")
    return df.groupBy(*keys).agg(ways[how].alias("cell_value"))


def grid_bins(
    df: DataFrame, longitude: str, latitude: str, size: float, value: str | None = None, how: str = "sum"
) -> DataFrame:
    """Square cells of ``size`` metres with one value each."""
    x, y = to_metres(F.col(longitude), F.col(latitude))
    cells = df.withColumns(
        {"cell_x": F.floor(x / size).cast("long"), "cell_y": F.floor(y / size).cast("long"), "__v": F.col(value) if value else F.lit(1.0)}
    )
    return _cell_values(cells, ["cell_x", "cell_y"], "__v", how)


def hex_cell(x: Column, y: Column, size: float) -> tuple[Column, Column]:
    """Axial coordinates of the pointy-top hexagon (circumradius ``size``) nearest to a point."""
    q = (x * (math.sqrt(3) / 3) - y / 3) / size
    r = (y * (2.0 / 3)) / size
    s = -q - r
    rq, rr, rs = F.rint(q), F.rint(r), F.rint(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    fixed_q = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    fixed_r = F.when((dq > dr) & (dq > ds), rr).otherwise(F.when(dr > ds, -rq - rs).otherwise(rr))
    return fixed_q.cast("long"), fixed_r.cast("long")


def hex_bins(
    df: DataFrame, longitude: str, latitude: str, size: float, value: str | None = None, how: str = "sum"
) -> DataFrame:
    x, y = to_metres(F.col(longitude), F.col(latitude))
    q, r = hex_cell(x, y, size)
    cells = df.withColumns({"hex_q": q, "hex_r": r, "__v": F.col(value) if value else F.lit(1.0)})
    return _cell_values(cells, ["hex_q", "hex_r"], "__v", how)


def weight_grid(df: DataFrame, longitude: str, latitude: str, degrees: float, weight: str) -> DataFrame:
    """Weight per degree cell, as the screen grid and the heat map draw it."""
    return df.groupBy(
        F.floor(F.col(longitude) / degrees).cast("long").alias("cell_x"),
        F.floor(F.col(latitude) / degrees).cast("long").alias("cell_y"),
    ).agg(F.sum(weight).alias("weight"))


def od_flows(df: DataFrame, origin: list[str], destination: list[str], metric: Column) -> DataFrame:
    return df.groupBy(*origin, *destination).agg(metric.alias("flow"))


def bounds(df: DataFrame, longitude: str, latitude: str, margin: float = 0.25) -> DataFrame:
    """Bounding box; a box without extent is widened inside the limits of the globe."""
    box = df.agg(
        F.min(longitude).alias("a"), F.max(longitude).alias("b"), F.min(latitude).alias("c"), F.max(latitude).alias("d")
    )
    flat_x, flat_y = F.col("a") == F.col("b"), F.col("c") == F.col("d")
    return box.select(
        F.when(flat_x, F.greatest(F.col("a") - margin, F.lit(-180.0))).otherwise(F.col("a")).alias("min_longitude"),
        F.when(flat_x, F.least(F.col("b") + margin, F.lit(180.0))).otherwise(F.col("b")).alias("max_longitude"),
        F.when(flat_y, F.greatest(F.col("c") - margin, F.lit(-90.0))).otherwise(F.col("c")).alias("min_latitude"),
        F.when(flat_y, F.least(F.col("d") + margin, F.lit(90.0))).otherwise(F.col("d")).alias("max_latitude"),
    )


def delimited_point(text: Column, reverse: bool = False) -> tuple[Column, Column]:
    """Latitude and longitude out of ``"lat,lon"``."""
    first = F.trim(F.split_part(text, F.lit(","), F.lit(1))).try_cast("double")
    second = F.trim(F.split_part(text, F.lit(","), F.lit(2))).try_cast("double")
    return (second, first) if reverse else (first, second)


def point_clusters(df: DataFrame, longitude: str, latitude: str, value: str, zooms: list[int]) -> DataFrame:
    """Tile cells per zoom with mergeable sums (count, sum, squares, min, max) and the mean point."""
    lat = F.least(F.greatest(F.col(latitude), F.lit(-85.05112878)), F.lit(85.05112878))
    x = (F.col(longitude) + 180) / 360
    y = (1 - F.log(F.tan(F.radians(lat)) + 1 / F.cos(F.radians(lat))) / math.pi) / 2
    based = df.select(
        F.col(longitude).alias("__lon"), F.col(latitude).alias("__lat"), F.col(value).cast("double").alias("__v"),
        x.alias("__x"), y.alias("__y"), F.explode(F.array(*[F.lit(z) for z in zooms])).alias("zoom"),
    )
    scale = F.pow(F.lit(2.0), F.col("zoom"))
    cells = based.groupBy(
        "zoom",
        F.floor(F.col("__x") * scale).cast("long").alias("tile_x"),
        F.floor(F.col("__y") * scale).cast("long").alias("tile_y"),
    ).agg(
        F.count(F.lit(1)).alias("points"),
        F.sum("__v").alias("sum"),
        F.sum(F.col("__v") * F.col("__v")).alias("squared_sum"),
        F.min("__v").alias("min"),
        F.max("__v").alias("max"),
        F.avg("__lon").alias("longitude"),
        F.avg("__lat").alias("latitude"),
    )
    mean = F.try_divide(F.col("sum"), F.col("points"))
    return cells.withColumns(
        {"mean": mean, "variance": F.try_divide(F.col("squared_sum"), F.col("points")) - mean * mean}
    )


