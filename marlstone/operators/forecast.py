"""Forecast of time series: trend plus seasonal waves by least squares.

The fit needs only sums of products, so Spark adds them up per series and the
small linear systems (one row per series) are solved in vectorised batches;
no series is gathered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grains import GRAIN_STEP
from .ordered import null_safe_join
from .postprocess import OperatorError, col, require, total_row

DAY = 86_400.0


def _normal_quantile(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)


def _waves(span: str | bool | int, period: float, order: int) -> list[float]:
    if not span or span == "auto":
        return []
    count = order if span is True else int(span)
    return [2 * math.pi * k / period for k in range(1, count + 1)]


def forecast(
    df: DataFrame,
    time_grain: str,
    periods: int,
    confidence_interval: float,
    yearly_seasonality: bool | int = False,
    weekly_seasonality: bool | int = False,
    daily_seasonality: bool | int = False,
    index: str = "__timestamp",
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """History plus ``periods`` future rows, with ``__yhat``, ``__yhat_lower``, ``__yhat_upper``."""
    if not time_grain:
        raise OperatorError("a time grain is needed")
    if time_grain not in GRAIN_STEP:
        raise OperatorError(f"unsupported time grain: {time_grain}")
    if not 0 < confidence_interval < 1:
        raise OperatorError("the confidence interval must lie between 0 and 1")
    if periods < 0 or int(periods) != periods:
        raise OperatorError("the number of periods must not be negative")
    require(df, [index])
    numeric = [n for n, t in df.dtypes if n != index and n not in keys and not t.startswith(("string", "timestamp"))]
    chosen = list(columns) if columns else numeric
    if not chosen:
        raise OperatorError("there is nothing to forecast")
    df = df.withColumn(index, col(index).cast("timestamp_ntz"))
    ends = total_row(df, {"lo": F.min(col(index)), "hi": F.max(col(index))})
    lo, hi = ends.getField("lo"), ends.getField("hi")
    seconds = F.timestamp_diff("SECOND", lo, col(index)).cast("double")
    width = F.greatest(F.timestamp_diff("SECOND", lo, hi).cast("double"), F.lit(1.0))
    rates = [
        *_waves(yearly_seasonality, 365.25 * DAY, 5),
        *_waves(weekly_seasonality, 7 * DAY, 3),
        *_waves(daily_seasonality, DAY, 4),
    ]
    features: list[Column] = [F.lit(1.0), seconds / width]
    for rate in rates:
        features += [F.sin(seconds * rate), F.cos(seconds * rate)]
    size = len(features)
    history = df.select(*[col(k) for k in keys], col(index), *[col(c).cast("double").alias(c) for c in chosen])
    with_x = history.select("*", *[f.alias(f"__x{i}") for i, f in enumerate(features)])
    solved = None
    for c in chosen:
        known = with_x.filter(col(c).isNotNull())
        sums = [F.sum(F.col(f"__x{i}") * F.col(f"__x{j}")) for i in range(size) for j in range(i, size)]
        sums += [F.sum(F.col(f"__x{i}") * col(c)) for i in range(size)]
        sums += [F.sum(col(c) * col(c)), F.count(F.lit(1)).cast("double")]
        moments = known.groupBy(*[col(k) for k in keys]).agg(*[s.alias(f"__s{i}") for i, s in enumerate(sums)])
        packed = moments.select(*[col(k) for k in keys], F.array(*[F.col(f"__s{i}") for i in range(len(sums))]).alias("__m"))
        part = packed.select(*[col(k) for k in keys], _solver(size)(F.col("__m")).alias(f"__fit_{c}"))
        solved = part if solved is None else null_safe_join(solved, part, list(keys)) if keys else solved.select(
            "*", part.select(f"__fit_{c}").scalar().alias(f"__fit_{c}")
        )
    step = GRAIN_STEP[time_grain]
    amount, unit = step.split()
    both = history
    if periods:
        series = history.select(*[col(k) for k in keys]).distinct() if keys else solved.select()
        steps = series.select(*[col(k) for k in keys], F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("__i"))
        moved = F.timestamp_add(unit.rstrip("s").upper(), (F.col("__i") * int(amount)).cast("int"), hi)
        future = steps.select(*[col(k) for k in keys], moved.alias(index))
        both = history.unionByName(future, allowMissingColumns=True)
    if keys:
        joined = null_safe_join(both, solved, list(keys))
        fits = {c: F.col(f"`__fit_{c}`") for c in chosen}
    else:
        joined = both
        row = solved.select(F.struct("*").alias("t")).scalar()
        fits = {c: row.getField(f"__fit_{c}") for c in chosen}
    z = _normal_quantile(0.5 + confidence_interval / 2)
    outs = []
    for c in chosen:
        beta, sigma = fits[c].getField("beta"), fits[c].getField("sigma")
        yhat = sum((F.get(beta, F.lit(i)) * f for i, f in enumerate(features)), F.lit(0.0))
        outs += [
            col(c),
            yhat.alias(f"{c}__yhat"),
            (yhat - F.lit(z) * sigma).alias(f"{c}__yhat_lower"),
            (yhat + F.lit(z) * sigma).alias(f"{c}__yhat_upper"),
        ]
    return joined.select(*[col(k) for k in keys], col(index), *outs)


def _solver(size: int):
    """Least squares from the moments of one series."""
    places = [(i, j) for i in range(size) for j in range(i, size)]

    @F.pandas_udf("beta array<double>, sigma double")
    def solve(moments: pd.Series) -> pd.DataFrame:
        betas, sigmas = [], []
        for row in moments:
            row = np.asarray(row, dtype=float)
            gram = np.zeros((size, size))
            for value, (i, j) in zip(row, places):
                gram[i, j] = gram[j, i] = value
            right = row[len(places):len(places) + size]
            squares, n = row[-2], row[-1]
            beta = np.linalg.lstsq(gram, right, rcond=1e-12)[0]
            residual = max(squares - beta @ right, 0.0)
            betas.append(beta.tolist())
            sigmas.append(math.sqrt(residual / max(n - size, 1.0)))
        return pd.DataFrame({"beta": betas, "sigma": sigmas})

    return solve
