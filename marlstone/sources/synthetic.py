"""Random columns and tables that come out the same after a lost task.

Every value is a function of the row's key and a seed, never of the partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def uniform(key: Column, seed: int) -> Column:
    """Number in (0, 1) from a hash of the key."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def normal(key: Column, seed: int, mean: float = 0.0, deviation: float = 1.0) -> Column:
    radius = F.sqrt(-2.0 * F.log(uniform(key, seed)))
    return F.lit(mean) + F.lit(deviation) * radius * F.cos(2.0 * math.pi * uniform(key, seed + 1_000_003))


def log_normal(key: Column, seed: int, mean: float, deviation: float) -> Column:
    """Log-normal with the given mean and deviation of the values themselves."""
    sigma2 = math.log(1 + (deviation / mean) ** 2)
    return F.exp(normal(key, seed, math.log(mean) - sigma2 / 2, math.sqrt(sigma2)))


def exponential(key: Column, seed: int, mean: float) -> Column:
    return -F.log(uniform(key, seed)) * mean


def _mix(state: np.ndarray) -> np.ndarray:
    """One step of the splitmix64 generator on a whole array."""
    with np.errstate(over="ignore"):
        z = state + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _draw(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    state = _mix(state)
    return state, ((state >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def poisson(key: Column, seed: int, mean: float) -> Column:
    """Poisson numbers by multiplying uniforms, a whole batch at a time."""

    @F.pandas_udf("long")
    def draw(seeds: pd.Series) -> pd.Series:
        state = seeds.to_numpy().astype(np.int64).view(np.uint64).copy()
        limit, count = math.exp(-mean), np.zeros(len(state), dtype=np.int64)
        product = np.ones(len(state))
        alive = np.ones(len(state), dtype=bool)
        while alive.any():
            state, u = _draw(state)
            product = np.where(alive, product * u, product)
            alive = alive & (product > limit)
            count += alive
        return pd.Series(count)

    return draw(F.xxhash64(key, F.lit(seed)))


def gamma(key: Column, seed: int, shape: float, scale: float) -> Column:
    """Gamma numbers (shape at least 1) by squeeze and accept, a whole batch at a time."""
    if shape < 1:
        raise ValueError("the shape must be at least 1")

    @F.pandas_udf("double")
    def draw(seeds: pd.Series) -> pd.Series:
        state = seeds.to_numpy().astype(np.int64).view(np.uint64).copy()
        d = shape - 1.0 / 3.0
        c = 1.0 / math.sqrt(9.0 * d)
        out = np.zeros(len(state))
        alive = np.ones(len(state), dtype=bool)
        while alive.any():
            state, a = _draw(state)
            state, b = _draw(state)
            state, u = _draw(state)
            x = np.sqrt(-2.0 * np.log(a)) * np.cos(2.0 * math.pi * b)
            v = (1.0 + c * x) ** 3
            with np.errstate(invalid="ignore", divide="ignore"):
                good = (v > 0) & (np.log(u) < 0.5 * x * x + d - d * v + d * np.log(np.where(v > 0, v, 1.0)))
            out = np.where(alive & good, d * v * scale, out)
            alive = alive & ~good
        return pd.Series(out)

    return draw(F.xxhash64(key, F.lit(seed)))


def random_value(kind: str, key: Column, seed: int) -> Column:
    u = uniform(key, seed)
    kinds = {
        "integer": lambda: F.floor(u * 1_000_000).cast("int"),
        "bigint": lambda: F.floor(u * 1e12).cast("long"),
        "float": lambda: (u * 1000).cast("float"),
        "double": lambda: u * 1000,
        "boolean": lambda: u < 0.5,
        "date": lambda: F.date_add(F.lit("2020-01-01").cast("date"), F.floor(u * 3650).cast("int")),
        "timestamp": lambda: F.timestamp_add("SECOND", F.floor(u * 3.15e8).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")),
        "time": lambda: F.date_format(F.timestamp_seconds(F.floor(u * 86400)), "HH:mm:ss"),
        "string": lambda: F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(seed))), 1, 16),
    }
    if kind not in kinds:
        raise ValueError(f"no random values of type {kind}")
    return kinds[kind]()


def synthetic_columns(
    df: DataFrame, key: str, columns: Sequence[tuple[str, str, bool]], seed: int = 0, null_share: float = 0.1
) -> DataFrame:
    """Add random columns ``(name, type, nullable)`` to the rows of ``df``."""
    k = F.col(key)
    added = []
    for i, (name, kind, nullable) in enumerate(columns):
        value = random_value(kind, k, seed + 2 * i)
        if nullable:
            value = F.when(uniform(k, seed + 2 * i + 1) >= null_share, value)
        added.append(value.alias(name))
    return df.select("*", *added)


def synthetic_table(
    spark: SparkSession, rows: int, columns: Sequence[tuple[str, str, bool]], seed: int = 0
) -> DataFrame:
    return synthetic_columns(spark.range(rows), "id", columns, seed).drop("id")


def wide_columns(count: int) -> list[tuple[str, str, bool]]:
    """Specification of a wide table of mixed types."""
    kinds = ("integer", "bigint", "double", "boolean", "date", "timestamp", "string")
    return [(f"col{i}", kinds[i % len(kinds)], i % 2 == 1) for i in range(count)]
