"""Comparing a period with earlier ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timerange
from ..functions.grains import bucket, offset_key, wall
from ..plans.builder import aggregated, all_columns, bounds
from ..plans.filters import between
from ..plans.request import TIME_LABEL, Dataset, Dim, Request, RequestError, label_of
from .postprocess import compare


def time_axis(request: Request) -> tuple[str, str]:
    """Label and grain of the time dimension."""
    for c in all_columns(request):
        if isinstance(c, Dim) and c.grain:
            return c.label, c.grain
        if c == TIME_LABEL and request.grain:
            return TIME_LABEL, request.grain
    raise RequestError("time comparison needs a time grain")


def with_offsets(dataset: Dataset, request: Request, now: datetime) -> DataFrame:
    """The request plus, per offset, the metrics of the shifted range as ``metric__offset``.

    Each shifted query scans its own range (pushed to the files), so the bytes
    read are those of the ranges and not of the table times the offsets.
    """
    since, until = bounds(request, now)
    if since is None or until is None:
        raise RequestError("time comparison needs a closed time range")
    axis, grain = time_axis(request)
    base = replace(request, time_offsets=(), row_limit=None, row_offset=0)
    out = aggregated(dataset, base, now)
    dims = [label_of(c) for c in all_columns(request) if label_of(c) != axis]
    time_name = request.time_column or dataset.time_column
    metrics = [label_of(m) for m in request.metrics]
    for offset in request.time_offsets:
        amount, unit = timerange.delta_text(offset)
        move = timerange.step(amount, unit)
        kept = [f for f in request.filters if not (f.op.upper() == "TEMPORAL_RANGE" and f.column == time_name)]
        other = aggregated(
            dataset, replace(base, filters=kept), now, span=(since + move, until + move)
        )
        shifted = F.timestamp_add(unit.upper(), F.lit(amount), wall(F.col(f"`{axis}`")))
        right = other.select(
            offset_key(F.col(f"`{axis}`"), grain).alias("__key"),
            *[F.col(f"`{d}`").alias(f"__d{i}") for i, d in enumerate(dims)],
            *[F.col(f"`{m}`").alias(f"{m}__{offset}") for m in metrics],
        )
        match = offset_key(F.col(f"`{axis}`"), grain, shifted) == F.col("__key")
        for i, d in enumerate(dims):
            match = match & F.col(f"`{d}`").eqNullSafe(F.col(f"__d{i}"))
        out = out.join(right, match, "left").drop("__key", *[f"__d{i}" for i in range(len(dims))])
    return out


def compare_series(
    df: DataFrame, metrics: Sequence[str], offset: str, kind: str, precision: int = 4
) -> DataFrame:
    """Replace the actual and the shifted metrics by their difference, percentage or ratio."""
    return compare(df, list(metrics), [f"{m}__{offset}" for m in metrics], kind, True, precision)


def change(current: Column, previous: Column) -> Column:
    """Relative change: nothing on both sides is 0, something new is 1, something gone is -1."""
    a, b = F.coalesce(current, F.lit(0.0)), F.coalesce(previous, F.lit(0.0))
    return (
        F.when((a == 0) & (b == 0), F.lit(0.0))
        .when(b == 0, F.lit(1.0))
        .when(a == 0, F.lit(-1.0))
        .otherwise(F.try_divide(a - b, F.abs(b)))
    )


def period_over_period(
    df: DataFrame,
    time: str,
    metrics: dict[str, Column],
    current: tuple[datetime, datetime],
    previous: tuple[datetime, datetime],
    groupby: Sequence[str] = (),
) -> DataFrame:
    """Sums of both ranges from one scan: value, previous, difference, change."""
    dtype = df.schema[time].dataType
    in_current = between(F.col(time), dtype, *current)
    in_previous = between(F.col(time), dtype, *previous)
    sums = []
    for label, value in metrics.items():
        sums += [
            F.sum(F.when(in_current, value)).alias(f"{label}__current"),
            F.sum(F.when(in_previous, value)).alias(f"{label}__previous"),
        ]
    out = df.filter(in_current | in_previous).groupBy(*groupby).agg(*sums)
    columns = []
    for label in metrics:
        a, b = F.col(f"`{label}__current`"), F.col(f"`{label}__previous`")
        columns += [
            a.alias(label),
            b.alias(f"{label}_previous"),
            (F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0))).alias(f"{label}_difference"),
            change(a, b).alias(f"{label}_change"),
        ]
    return out.select(*groupby, *columns)


def big_number(df: DataFrame, time: str, metric: str, compare_lag: int) -> DataFrame:
    """Latest known value and its change against the row ``compare_lag`` buckets back."""
    latest = df.filter(F.col(metric).isNotNull()).agg(F.max(time).alias("t")).scalar()
    recent = df.filter(F.col(time) <= latest).orderBy(F.col(time).desc()).limit(compare_lag + 1)
    out = recent.agg(
        F.max(time).alias(time),
        F.max_by(metric, time).alias("value"),
        F.when(F.count(F.lit(1)) == compare_lag + 1, F.min_by(metric, time)).alias("compare_value"),
    )
    moved = F.col("value") - F.col("compare_value")
    return out.withColumn(
        "change",
        F.when(F.col("compare_value") == 0, F.lit(0.0)).otherwise(F.try_divide(moved, F.abs(F.col("compare_value")))),
    )


def fold_time(time: Column, frequency: str) -> tuple[Column, Column]:
    """Start of the period and the place inside it, in days."""
    day = F.date_trunc("day", time).cast("timestamp_ntz")
    if frequency == "AS":
        start = bucket(time, "P1Y")
    elif frequency == "W-MON":
        start = bucket(time, "P1W")
    elif frequency == "D":
        start = day
        return start, F.hour(time)
    elif frequency in ("52W-MON", "4W-MON"):
        weeks = int(frequency.split("W")[0])
        monday = F.lit("1969-12-29").cast("timestamp_ntz")
        passed = F.timestamp_diff("DAY", monday, day)
        start = F.timestamp_add("DAY", (F.floor(passed / (7 * weeks)) * (7 * weeks)).cast("int"), monday)
    else:
        raise RequestError(f"unknown frequency {frequency}")
    return start, F.timestamp_diff("DAY", start, day).cast("int")


def time_pivot(df: DataFrame, time: str, value: Column, frequency: str) -> DataFrame:
    """Overlay periods: value per period start and place in the period (long form)."""
    start, place = fold_time(F.col(time), frequency)
    return df.groupBy(start.alias("period"), place.alias("place")).agg(F.sum(value).alias("value"))
