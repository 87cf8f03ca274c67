"""Tables of a database over JDBC, read in parallel ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def reader_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    custom_schema: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of one read; ``split`` is (column, lowest, highest, parts)."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    named = {"user": user, "password": password, "driver": driver, "customSchema": custom_schema}
    options.update({k: v for k, v in named.items() if v is not None})
    if split:
        column, low, high, parts = split
        options.update(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
        )
    return options


def read_table(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**reader_options(**options)).load()


def write_table(
    df: DataFrame, url: str, table: str, user: str | None = None, password: str | None = None,
    driver: str | None = None, drop: tuple[str, ...] = (), mode: str = "overwrite", connections: int = 8,
) -> None:
    """Replace a table; ``connections`` bounds the parallel sessions at the database."""
    options = reader_options(url, table, user, password, driver)
    options.pop("fetchsize")
    df.drop(*drop).write.format("jdbc").options(**options).option("numPartitions", connections).option(
        "truncate", True
    ).mode(mode).save()
