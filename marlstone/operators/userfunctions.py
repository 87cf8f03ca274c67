"""User-defined functions, and the built-in forms that replace the slow ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from .ordered import BLOCK, OWN, POSITION, blocked, null_safe_join


def with_uuid(df: DataFrame, label: str) -> DataFrame:
    """A random identifier of 32 hex digits per row, made by the JVM."""
    return df.withColumn(label, F.regexp_replace(F.expr("uuid()"), "-", ""))


def subtract_group_mean(df: DataFrame, keys: Sequence[str], value: str, label: str) -> DataFrame:
    """Row value minus the mean of its group."""
    means = df.groupBy(*keys).agg(F.avg(value).alias("__mean"))
    return null_safe_join(df, means, list(keys)).withColumn(label, F.col(value) - F.col("__mean")).drop("__mean")


def udaf_mean(df: DataFrame, keys: Sequence[str], value: str, label: str) -> DataFrame:
    """Mean by a vectorised aggregate over partial sums.

    Partial sums per task come first, so the Python aggregate sees a few rows
    per group however large the group is.
    """

    @F.pandas_udf("double")
    def combine(sums: pd.Series, counts: pd.Series) -> float:
        total = counts.sum()
        return float(sums.sum() / total) if total else None

    part = F.spark_partition_id().alias("__part")
    partial = df.select(*keys, value, part).groupBy(*keys, "__part").agg(
        F.sum(value).alias("__sum"), F.count(value).alias("__count")
    )
    return partial.groupBy(*keys).agg(combine("__sum", "__count").alias(label))


def window_function(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]],
    value: str,
    label: str,
    fn: Callable[[np.ndarray], np.ndarray],
    before: int,
    after: int = 0,
    block_rows: int = 100_000,
) -> DataFrame:
    """A vectorised function over the frame of ``before`` rows, the row and ``after`` rows of every row.

    ``fn`` is given many frames at a time, a row of numbers each, and returns a
    number per frame.  Nulls, and places before the first and behind the last
    row of a key, are NaN; NaN comes back as null.  Blocks of ``block_rows``
    rows go to Python with the neighbours that their frames need, so a key is
    spread over as many tasks as it has blocks.
    """
    if before < 0 or after < 0:
        raise ValueError("a frame holds its own row")
    spread, _ = blocked(df, keys, order, before, after, block_rows)
    names = list(df.columns)

    def frames(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(POSITION)
        numbers = pd.to_numeric(block[value]).to_numpy(dtype=float, na_value=np.nan)
        padded = np.concatenate([np.full(before, np.nan), numbers, np.full(after, np.nan)])
        own = block[OWN].to_numpy(dtype=bool)
        seen = np.lib.stride_tricks.sliding_window_view(padded, before + 1 + after)[own]
        out = block.loc[own, names].copy()
        made = np.asarray(fn(seen), dtype=float)
        out[label] = pd.Series(np.where(np.isnan(made), None, made), index=out.index, dtype=object)
        return out

    schema = T.StructType([*df.schema.fields, T.StructField(label, T.DoubleType())])
    return spread.groupBy(*[F.col(f"`{k}`") for k in keys], BLOCK).applyInPandas(frames, schema)


def two_phase_average(df: DataFrame, keys: Sequence[str], value: str, label: str) -> DataFrame:
    """Average as its (sum, count) buffer and the final division."""
    buffer = df.groupBy(*keys).agg(F.struct(F.sum(value).alias("sum"), F.count(value).alias("count")).alias("__buffer"))
    return buffer.select(*keys, F.try_divide(F.col("__buffer.sum"), F.col("__buffer.count")).alias(label))


def register_text_length(spark: SparkSession, name: str) -> None:
    """A vectorised function callable from SQL."""

    @F.pandas_udf("long")
    def text_length(s: pd.Series) -> pd.Series:
        return s.str.len()

    spark.udf.register(name, text_length)
