"""Example datasets with explicit types, read from CSV or JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column types of the example datasets.
SCHEMAS = {
    "birth_names": "ds timestamp_ntz, gender string, name string, num bigint, state string, num_boys bigint, num_girls bigint",
    "energy_links": "source string, target string, value double",
    "long_lat": "longitude double, latitude double, number double, street string, unit string, city string, district string, "
    "region string, postcode double, id string, datetime timestamp_ntz, occupancy double, radius_miles double, geohash string, "
    "delimited string",
    "multiformat_time": "ds date, ds2 timestamp_ntz, epoch_s bigint, epoch_ms bigint, string0 string, string1 string, "
    "string2 string, string3 string",
    "movies": "movieId string, title string, genres string",
    "ratings": "userId string, movieId string, rating double, timestamp bigint",
}

# Text formats of the four text columns of the multi-format table.
TEXT_TIMES = {"string0": "%Y-%m-%d %H:%M:%S", "string1": "%Y-%m-%d", "string2": "%Y%m%d%H%M%S", "string3": "%Y/%m/%d%H:%M:%S"}


def load_dataset(spark: SparkSession, name: str, path: str, style: str = "csv") -> DataFrame:
    """One example dataset; unreadable cells become null."""
    if name not in SCHEMAS:
        raise ValueError(f"unknown dataset {name}")
    reader = spark.read.schema(SCHEMAS[name])
    df = reader.option("header", True).csv(path) if style == "csv" else reader.json(path)
    if name == "ratings":
        df = df.withColumn("timestamp", F.timestamp_seconds("timestamp").cast("timestamp_ntz"))
    return df


def point_column(df: DataFrame) -> DataFrame:
    """The ``lat,lon`` text of the long/lat table, where it is missing."""
    text = F.concat_ws(",", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    return df.withColumn("delimited", F.coalesce("delimited", text))
