"""Exact quantiles without gathering a group's values in one place.

Equal values are counted first, the counts are prefixed chunk by chunk, and the
values standing at the wanted ranks are picked by a filter.  A group may hold
any share of the table; a caller who knows its groups to be small may take the
built-in ``percentile`` with ``small=True``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import Running, null_safe_join, running


def rank_counts(df: DataFrame, keys: Sequence[str], value: str, chunks: int | None = None) -> DataFrame:
    """Distinct values per group with first and last 0-based rank and the group size."""
    keys = list(keys)
    counted = (
        df.filter(F.col(f"`{value}`").isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("__copies"))
    )
    summed = running(counted, keys, [(value, True)], {"__upto": Running("sum", "__copies")}, chunks)
    sizes = counted.groupBy(*keys).agg(F.sum("__copies").alias("__size"))
    if keys:
        sized = null_safe_join(summed, sizes, keys, "inner")
    else:
        sized = summed.withColumn("__size", sizes.scalar())
    return sized.select(
        *[F.col(f"`{k}`") for k in keys],
        F.col(f"`{value}`").alias("__value"),
        (F.col("__upto") - F.col("__copies")).alias("__first"),
        (F.col("__upto") - 1).alias("__last"),
        "__size",
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    method: str = "linear",
    chunks: int | None = None,
    small: bool = False,
) -> DataFrame:
    """One row per group with a column per named probability.

    ``linear`` interpolates between the two neighbouring ranks, ``midpoint``
    takes their mean, ``lower`` and ``higher`` take one of them.
    """
    keys = list(keys)
    if small:
        return _within_groups(df, keys, value, probabilities, method)
    ranks = rank_counts(df, keys, value, chunks)

    def at(rank: Column) -> Column:
        hit = (F.col("__first") <= rank) & (rank <= F.col("__last"))
        return F.max(F.when(hit, F.col("__value").cast("double")))

    picks: list[Column] = []
    for i, p in enumerate(probabilities.values()):
        exact = (F.col("__size") - 1) * F.lit(float(p))
        picks += [
            at(F.floor(exact)).alias(f"__lo{i}"),
            at(F.ceil(exact)).alias(f"__hi{i}"),
            F.max(exact - F.floor(exact)).alias(f"__part{i}"),
        ]
    grouped = ranks.groupBy(*keys).agg(*picks)
    outs = [
        _between(F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__part{i}"), method).alias(name)
        for i, name in enumerate(probabilities)
    ]
    return grouped.select(*[F.col(f"`{k}`") for k in keys], *outs)


def _between(low: Column, high: Column, part: Column, method: str) -> Column:
    ways = {"linear": low + (high - low) * part, "midpoint": (low + high) / 2, "lower": low, "higher": high}
    if method not in ways:
        raise ValueError(f"unknown quantile method {method}")
    return ways[method]


def _within_groups(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], method: str
) -> DataFrame:
    """One aggregation, for groups that the caller knows to be small."""
    names = [F.col(f"`{k}`") for k in keys]
    v = F.col(f"`{value}`").cast("double")
    grouped = df.filter(F.col(f"`{value}`").isNotNull()).groupBy(*names)
    if method == "linear":
        wanted = F.array(*[F.lit(float(p)) for p in probabilities.values()])
        found = grouped.agg(F.percentile(v, wanted).alias("__q"))
        return found.select(*names, *[F.get("__q", F.lit(i)).alias(n) for i, n in enumerate(probabilities)])
    held = grouped.agg(F.array_sort(F.collect_list(v)).alias("__v"))
    outs = []
    for name, p in probabilities.items():
        place = (F.size("__v") - 1) * F.lit(float(p))
        low, high = F.get("__v", F.floor(place).cast("int")), F.get("__v", F.ceil(place).cast("int"))
        outs.append(_between(low, high, place - F.floor(place), method).alias(name))
    return held.select(*names, *outs)
