"""Running a stream to the end of what is there, and reading its result.

Sinks, checkpoints and landed files live in the shared folder, so a query can
be picked up by another driver.  Update-mode results are written per
micro-batch (a repeated batch overwrites itself) and read back as the latest
row per key; nothing is rewritten as a whole and nothing goes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def stream_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet files as a stream; a batch holds at most ``files_per_batch`` files.

    A table may be one file or a folder of files; the source takes a single file
    only as a pattern, so the last letter of the name is written as one.
    """
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if path.endswith(".parquet"):
        path = f"{path[:-1]}[{path[-1]}]"
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def land(df: DataFrame, order: str, files: int, label: str) -> str:
    """Write a table as files in the order of a column, as a feed would land them."""
    path = scratch_path(df.sparkSession, label)
    df.repartitionByRange(files, order).sortWithinPartitions(order).write.parquet(path)
    return path


def land_parts(df: DataFrame, part: Column, parts: int, files: int, label: str) -> str:
    """Write the rows of part 0, 1, ... one after another, ``files`` files each.

    Read with as many files per batch, a micro-batch is one part.
    """
    path = scratch_path(df.sparkSession, label)
    for k in range(parts):
        df.where(part == k).repartition(files).write.mode("append").parquet(path)
    return path


def event_time(df: DataFrame, column: str, delay: str | None = None) -> DataFrame:
    """Cast a wall-clock column so that it can carry a watermark."""
    out = df.withColumn(column, F.col(column).cast("timestamp"))
    return out.withWatermark(column, delay) if delay else out


def wall_window(df: DataFrame) -> DataFrame:
    """The window struct as two wall-clock columns."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("window", "session_window")]
    name = "window" if "window" in df.columns else "session_window"
    return df.select(
        F.col(f"{name}.start").cast("timestamp_ntz").alias("start"),
        F.col(f"{name}.end").cast("timestamp_ntz").alias("end"),
        *rest,
    )


def run_append(stream: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None) -> str:
    """Process what is available into Parquet files; returns the folder."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint or scratch_path(spark, f"{label}-checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return path


def run_batches(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    label: str,
    mode: str = "append",
    checkpoint: str | None = None,
) -> None:
    """Process what is available, handing every micro-batch to ``each``."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, f"{label}-checkpoint"))
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_update(
    stream: DataFrame, keys: Sequence[str], label: str, path: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Process what is available in update mode; returns the latest row per key."""
    path = path or scratch_path(stream.sparkSession, label)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    run_batches(stream, keep, label, "update", checkpoint)
    return latest(stream.sparkSession, path, stream.schema, keys)


def latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    written = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(written).parquet(path)
    values = [c for c in schema.names if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__v"))
    return newest.select(*keys, "__v.*")
