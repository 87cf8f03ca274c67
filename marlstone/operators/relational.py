"""Relational helpers that need more than one DataFrame call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str, always_suffix: bool = False
) -> DataFrame:
    """Left join on shared keys; clashing columns of the right side get ``suffix``."""
    rename = {
        c: f"{c}{suffix}" for c in right.columns if c not in on and (always_suffix or c in left.columns)
    }
    return left.join(right.withColumnsRenamed(rename), list(on), "left")


def cogroup(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both inputs under one key, tagged by ``side``.

    The groups stay rows, so a key of any size can be aggregated map-side.
    """
    extra = [c for c in [*left.columns, *right.columns] if c not in keys]
    tagged = left.withColumn("side", F.lit("left")).unionByName(
        right.withColumn("side", F.lit("right")), allowMissingColumns=True
    )
    return tagged.select(*keys, "side", *dict.fromkeys(extra))


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """Inner join with a lookup table.

    Whether it is shipped to every task is left to the engine, which goes by
    its size in bytes, first estimated and then as measured while running.
    """
    return df.join(lookup, F.col(key) == F.col(lookup_key), "inner")


def stat_counter(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sum, extremes and both spreads from one pass."""
    c = F.col(column)
    return df.agg(
        F.count(c).alias("count"),
        F.round(F.avg(c), 8).alias("mean"),
        F.round(F.sum(c), 4).alias("sum"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.round(F.var_pop(c), 4).alias("variance"),
        F.round(F.var_samp(c), 4).alias("sample_variance"),
        F.round(F.stddev_pop(c), 6).alias("stdev"),
        F.round(F.stddev_samp(c), 6).alias("sample_stdev"),
    )


def words(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.explode(F.split(F.col(text), " ")).alias("word")).filter("word <> ''")


def word_count(df: DataFrame, text: str) -> DataFrame:
    return words(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# Fixed value: shape of one access-log line.
_LOG = r'^(\S+) \S+ (\S+) \["([^"]*)"\] (\d+) (\d+)'


def log_query(df: DataFrame, line: str) -> DataFrame:
    """Requests and bytes per (ip, user, query); lines that do not parse share the null key."""
    fits = F.col(line).rlike(_LOG)

    def part(i: int):
        return F.when(fits, F.regexp_extract(line, _LOG, i))

    parsed = df.select(part(1).alias("ip"), part(2).alias("user"), part(3).alias("query"), part(5).cast("long").alias("bytes"))
    return parsed.groupBy("ip", "user", "query").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))


def salted_group(
    df: DataFrame, keys: Sequence[str], distinct: str, sums: dict[str, tuple[str, str | None]], distinct_label: str
) -> DataFrame:
    """Group in two stages: by key and value first, which splits a hot key, then by key."""
    ways = {"count": lambda c: F.count(F.lit(1) if c is None else F.col(c)), "sum": lambda c: F.sum(c)}
    first = df.groupBy(*keys, distinct).agg(*[ways[kind](c).alias(label) for label, (kind, c) in sums.items()])
    return first.groupBy(*keys).agg(
        *[F.sum(label).alias(label) for label in sums], F.count(F.col(distinct)).alias(distinct_label)
    )


def take_sample(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows without replacement (a distributed top-n by random number)."""
    return df.withColumn("__r", F.rand(seed)).orderBy("__r").limit(n).drop("__r")


def take_sample_replaced(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` draws with replacement: the draws are random row positions."""
    from .ordered import Running, running

    placed = running(df, [], [(key, True)], {"__place": Running("row_number")})
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    draws = df.sparkSession.range(n).select((F.floor(F.rand(seed) * total) + 1).alias("__draw"))
    return placed.join(draws, F.col("__place") == F.col("__draw")).drop("__place", "__draw")
