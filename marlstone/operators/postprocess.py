"""Post-processing of result frames.

A frame is a DataFrame in long form: time, series keys, metrics.  Operators that
depend on row order take ``order`` (and ``keys``, the series columns) and work
on frames of any size through chunks and blocks (see ``ordered``).  Frames
bucketed by a time grain have at most one row per series and bucket; for those
``row_level=False`` asks for one plain window per series instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geohash as geo
from ..functions.labels import flatten as flat_label
from .ordered import Running, null_safe_join, running, sliding, sort_columns
from .quantiles import exact_quantiles


# Longest time axis that is held as one list.
MAX_TIMES = 100_000


class OperatorError(ValueError):
    """The operator cannot be applied to this frame."""


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def require(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise OperatorError(f"referenced columns not available: {', '.join(missing)}")


def _order(order: str | Sequence) -> list[tuple[str, bool]]:
    if not order:
        raise OperatorError("this operator needs an explicit order")
    items = [order] if isinstance(order, str) else list(order)
    return [(o, True) if isinstance(o, str) else (o[0], o[1]) for o in items]


def _numeric(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def total_row(df: DataFrame, aggregates: dict[str, Column]) -> Column:
    """A one-row aggregate of ``df`` as a scalar struct: no join, no window."""
    return df.agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("t")).scalar()


# --- aggregate -------------------------------------------------------------

_QUANTILES = {"median": 0.5, "nanmedian": 0.5, "percentile": None, "nanpercentile": None}


def _simple_aggregate(operator: str, c: Column) -> Column | None:
    rows = F.count(F.lit(1))
    known = F.count(c)
    table = {
        "mean": F.avg(c),
        "nanmean": F.avg(c),
        "average": F.when(known == rows, F.avg(c)),
        "count": rows,
        "count_nonzero": F.count_if((c != 0) | c.isNull()),
        "max": F.max(c),
        "nanmax": F.max(c),
        "min": F.min(c),
        "nanmin": F.min(c),
        "prod": F.coalesce(F.product(c), F.lit(1.0)),
        "product": F.coalesce(F.product(c), F.lit(1.0)),
        "std": F.stddev_pop(c),
        "var": F.var_pop(c),
        "sum": F.coalesce(F.sum(c), F.lit(0)),
        "nansum": F.coalesce(F.sum(c), F.lit(0)),
    }
    return table.get(operator)


def aggregate(
    df: DataFrame,
    groupby: Sequence[str],
    aggregates: dict[str, dict],
    order: str | Sequence = (),
) -> DataFrame:
    """Group and aggregate; rows with a null key are dropped.

    ``aggregates`` maps a label to ``{"column", "operator", "options"}``.
    ``argmin``/``argmax`` give positions and therefore need ``order``.
    """
    groupby = list(groupby)
    require(df, groupby)
    for key in groupby:
        df = df.filter(col(key).isNotNull())
    plain: dict[str, Column] = {}
    ranked: dict[str, tuple[str, float, bool]] = {}
    positioned: dict[str, tuple[str, str]] = {}
    for label, spec in aggregates.items():
        name, operator = spec.get("column", label), spec.get("operator")
        if not operator:
            raise OperatorError("an aggregate needs an operator")
        require(df, [name])
        if operator in ("argmin", "argmax"):
            positioned[label] = (name, operator)
        elif operator in _QUANTILES:
            q = _QUANTILES[operator]
            q = spec.get("options", {}).get("q", 50) / 100 if q is None else q
            ranked[label] = (name, q, not operator.startswith("nan"))
        else:
            expression = _simple_aggregate(operator, col(name))
            if expression is None:
                raise OperatorError(f"operator {operator} is not an aggregate")
            plain[label] = expression
    frame = df
    if positioned:
        frame = running(df, groupby, _order(order), {"__place": Running("row_number")})
        for label, (name, operator) in positioned.items():
            place = F.struct(col(name).alias("v"), (-F.col("__place")).alias("p"))
            if operator == "argmin":
                place = F.struct(col(name).alias("v"), F.col("__place").alias("p"))
            best = (F.min if operator == "argmin" else F.max)(F.when(col(name).isNotNull(), place))
            plain[label] = F.coalesce(F.abs(best.getField("p")) - 1, F.lit(-1))
    helpers = {f"__nulls_{label}": F.count_if(col(name).isNull()) for label, (name, _, strict) in ranked.items() if strict}
    out = frame.groupBy(*groupby).agg(
        *[c.alias(n) for n, c in {**plain, **helpers, "__rows": F.count(F.lit(1))}.items()]
    )
    by_column: dict[str, dict[str, float]] = {}
    for label, (name, q, _) in ranked.items():
        by_column.setdefault(name, {})[label] = q
    for name, wanted in by_column.items():
        found = exact_quantiles(df, groupby, name, wanted)
        if groupby:
            out = null_safe_join(out, found, groupby)
        else:
            row = found.select(F.struct("*").alias("t")).scalar()
            out = out.select("*", *[row.getField(n).alias(n) for n in wanted])
    chosen = []
    for label in aggregates:
        value = col(label)
        if label in ranked and ranked[label][2]:
            value = F.when(col(f"__nulls_{label}") == 0, value)
        chosen.append(value.alias(label))
    return out.select(*[col(k) for k in groupby], *chosen)


# --- box plot --------------------------------------------------------------


def boxplot(
    df: DataFrame,
    groupby: Sequence[str],
    metrics: Sequence[str],
    whisker_type: str = "tukey",
    percentiles: tuple[float, float] | None = None,
    outliers: str = "array",
) -> DataFrame:
    """Box plot statistics per group and metric.

    Quartiles take the mean of the two neighbouring ranks; percentile whiskers
    interpolate.  ``outliers="count"`` replaces the value list, whose size
    grows with the data, by its length; ``boxplot_outliers`` gives the rows.
    """
    groupby = list(groupby)
    require(df, [*groupby, *metrics])
    for key in groupby:
        df = df.filter(col(key).isNotNull())
    out = None
    for metric in metrics:
        source = df.select(*groupby, col(metric).try_cast("double").alias("__v"))
        fenced = _fences(source, groupby, whisker_type, percentiles)
        v, low, high = F.col("__v"), F.col("__low"), F.col("__high")
        above, below = F.when(v > high, v), F.when(v < low, v)
        stats = [
            F.avg(v).alias(f"{metric}__mean"),
            F.max("__median").alias(f"{metric}__median"),
            F.max(F.when(v <= high, v)).alias(f"{metric}__max"),
            F.min(F.when(v >= low, v)).alias(f"{metric}__min"),
            F.max("__q1").alias(f"{metric}__q1"),
            F.max("__q3").alias(f"{metric}__q3"),
            F.count(F.lit(1)).alias(f"{metric}__count"),
        ]
        if outliers == "array":
            listed = F.concat(F.array_sort(F.collect_list(above)), F.array_sort(F.collect_list(below)))
            stats.append(listed.alias(f"{metric}__outliers"))
        else:
            stats.append((F.count(above) + F.count(below)).alias(f"{metric}__outliers"))
        part = fenced.groupBy(*groupby).agg(*stats)
        out = part if out is None else null_safe_join(out, part, groupby)
    return out


def _fences(
    source: DataFrame, groupby: list[str], whisker_type: str, percentiles: tuple[float, float] | None
) -> DataFrame:
    quartiles = exact_quantiles(
        source, groupby, "__v", {"__q1": 0.25, "__median_mid": 0.5, "__q3": 0.75}, "midpoint"
    ).withColumnRenamed("__median_mid", "__median")
    spread = F.col("__q3") - F.col("__q1")
    if whisker_type == "tukey":
        low, high = F.col("__q1") - 1.5 * spread, F.col("__q3") + 1.5 * spread
    elif whisker_type == "min/max":
        low, high = F.lit(float("-inf")), F.lit(float("inf"))
    elif whisker_type == "percentile":
        if (
            not percentiles
            or len(percentiles) != 2
            or not 0 <= percentiles[0] < percentiles[1] <= 100
        ):
            raise OperatorError("percentile whiskers need two rising percentiles between 0 and 100")
        wanted = {"__p_low": percentiles[0] / 100, "__p_high": percentiles[1] / 100}
        quartiles = null_safe_join(quartiles, exact_quantiles(source, groupby, "__v", wanted), groupby)
        low, high = F.col("__p_low"), F.col("__p_high")
    else:
        raise OperatorError(f"unknown whisker type: {whisker_type}")
    return null_safe_join(source, quartiles.withColumns({"__low": low, "__high": high}), groupby)


def boxplot_outliers(
    df: DataFrame,
    groupby: Sequence[str],
    metric: str,
    whisker_type: str = "tukey",
    percentiles: tuple[float, float] | None = None,
) -> DataFrame:
    """The outliers themselves, one row each."""
    groupby = list(groupby)
    for key in groupby:
        df = df.filter(col(key).isNotNull())
    source = df.select(*groupby, col(metric).try_cast("double").alias("__v"))
    fenced = _fences(source, groupby, whisker_type, percentiles)
    return fenced.filter((F.col("__v") < F.col("__low")) | (F.col("__v") > F.col("__high"))).select(
        *groupby, F.col("__v").alias(metric)
    )


# --- column arithmetic -----------------------------------------------------


def compare(
    df: DataFrame,
    source_columns: Sequence[str],
    compare_columns: Sequence[str],
    compare_type: str,
    drop_original_columns: bool = False,
    precision: int = 4,
) -> DataFrame:
    """Difference, percentage or ratio of column pairs, as ``type__source__compare``."""
    if len(source_columns) != len(compare_columns) or not source_columns:
        raise OperatorError("source and compare columns must pair up")
    require(df, [*source_columns, *compare_columns])
    added = []
    for s, c in zip(source_columns, compare_columns):
        a, b = col(s).cast("double"), col(c).cast("double")
        if compare_type == "difference":
            value = a - b
        elif compare_type == "percentage":
            value = F.try_divide(a - b, b)
        elif compare_type == "ratio":
            value = F.try_divide(a, b)
        else:
            raise OperatorError(f"unknown comparison: {compare_type}")
        added.append(F.bround(value, precision).alias(f"{compare_type}__{s}__{c}"))
    out = df.select("*", *added)
    return out.drop(*source_columns, *compare_columns) if drop_original_columns else out


def contribution(
    df: DataFrame,
    orientation: str = "column",
    columns: Sequence[str] | None = None,
    time_shifts: Sequence[str] = (),
    rename_columns: Sequence[str] | None = None,
    totals_of: DataFrame | None = None,
) -> DataFrame:
    """Share of the row or column total; 0/0 gives null.

    ``totals_of`` is a frame with the same column totals that is cheaper to
    compute, such as the one before a left join.
    """
    chosen = list(columns) if columns else _numeric(df)
    require(df, chosen)
    names = list(rename_columns) if rename_columns else chosen
    if len(names) != len(chosen):
        raise OperatorError("as many new names as columns are needed")
    shares: dict[str, Column] = {}
    if orientation == "column":
        zero = {c: F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in chosen}
        whole = df if totals_of is None else totals_of
        sums = total_row(whole, {f"s{i}": F.sum(zero[c]) for i, c in enumerate(chosen)})
        for i, c in enumerate(chosen):
            shares[c] = F.try_divide(zero[c], sums.getField(f"s{i}"))
    elif orientation == "row":
        suffixes = [f"__{s}" for s in time_shifts]

        def group(c: str) -> str:
            return next((s for s in suffixes if c.endswith(s)), "")

        for g in {group(c) for c in chosen}:
            members = [c for c in chosen if group(c) == g]
            total = reduce(lambda a, b: a + b, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in members])
            for c in members:
                shares[c] = F.try_divide(col(c).cast("double"), total)
    else:
        raise OperatorError(f"unknown orientation: {orientation}")
    replaced = {n: shares[c] for c, n in zip(chosen, names)}
    kept = [replaced.pop(c).alias(c) if c in replaced else col(c) for c in df.columns]
    return df.select(*kept, *[v.alias(n) for n, v in replaced.items()])


# --- ordered operators -----------------------------------------------------


def _replace(df: DataFrame, values: dict[str, Column]) -> list[Column]:
    rest = dict(values)
    kept = [rest.pop(c).alias(c) if c in rest else col(c) for c in df.columns]
    return [*kept, *[v.alias(n) for n, v in rest.items()]]


def cum(
    df: DataFrame,
    operator: str,
    columns: dict[str, str],
    order: str | Sequence = (),
    keys: Sequence[str] = (),
    row_level: bool = True,
) -> DataFrame:
    """Running sum, product, minimum or maximum; nulls count as 0."""
    if operator not in ("sum", "prod", "min", "max"):
        raise OperatorError(f"unknown cumulative operator: {operator}")
    require(df, [*columns, *keys])
    order = _order(order)
    kind = {"prod": "product"}.get(operator, operator)
    filled = df.select("*", *[F.coalesce(col(s), F.lit(0)).alias(f"__z{i}") for i, s in enumerate(columns)])
    if row_level:
        specs = {f"__c{i}": Running(kind, f"__z{i}") for i in range(len(columns))}
        done = running(filled, keys, order, specs)
        values = {dst: F.col(f"__c{i}") for i, dst in enumerate(columns.values())}
    else:
        window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*sort_columns(order))
        to_here = window.rowsBetween(Window.unboundedPreceding, 0)
        done = filled
        values = {
            dst: getattr(F, kind)(F.col(f"__z{i}")).over(to_here) for i, dst in enumerate(columns.values())
        }
    return done.select(*_replace(df, values))


def diff(
    df: DataFrame,
    columns: dict[str, str],
    periods: int = 1,
    axis: str = "row",
    order: str | Sequence = (),
    keys: Sequence[str] = (),
    row_level: bool = True,
) -> DataFrame:
    """Difference to the row ``periods`` before (after, when negative) or to the column before."""
    require(df, [*columns, *keys])
    if axis == "column":
        names = list(columns)
        values = {
            columns[n]: (col(n) - col(names[i - periods]) if 0 <= i - periods < len(names) else F.lit(None).cast("double"))
            for i, n in enumerate(names)
        }
        return df.select(*_replace(df, values))
    order = _order(order)
    step = abs(periods)

    def moved(c: Column, window) -> Column:
        return F.lag(c, step).over(window) if periods >= 0 else F.lead(c, step).over(window)

    if row_level:
        make = {f"__d{i}": (lambda w, n=n: col(n) - moved(col(n), w)) for i, n in enumerate(columns)}
        done = sliding(df, keys, order, make, step if periods >= 0 else 0, step if periods < 0 else 0)
        return done.select(*_replace(df, {dst: F.col(f"__d{i}") for i, dst in enumerate(columns.values())}))
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*sort_columns(order))
    return df.select(*_replace(df, {dst: col(n) - moved(col(n), window) for n, dst in columns.items()}))


def _frame_quantile(c: Column, q: float, frame) -> Column:
    values = F.array_sort(F.collect_list(c).over(frame))
    place = (F.size(values) - 1) * F.lit(q)
    low = F.get(values, F.floor(place).cast("int"))
    high = F.get(values, F.ceil(place).cast("int"))
    return F.when(F.size(values) > 0, low + (high - low) * (place - F.floor(place)))


def rolling_value(rolling_type: str, c: Column, frame, options: dict, other: Column | None = None) -> Column:
    """One rolling statistic over a ROWS frame, before the ``min_periods`` rule."""
    n = F.count(c).over(frame).cast("double")
    ddof = options.get("ddof", 1)
    if rolling_type == "count":
        return n
    if rolling_type in ("sum", "min", "max"):
        value = getattr(F, rolling_type)(c).over(frame)
        return F.coalesce(value, F.lit(0.0)) if rolling_type == "sum" else value
    if rolling_type == "mean":
        return F.avg(c).over(frame)
    if rolling_type in ("std", "var"):
        centred = F.var_pop(c).over(frame)
        value = F.try_divide(centred * n, F.when(n > ddof, n - ddof))
        return F.sqrt(value) if rolling_type == "std" else value
    if rolling_type in ("median", "quantile"):
        q = 0.5 if rolling_type == "median" else options.get("quantile", options.get("q", 0.5))
        return _frame_quantile(c, q, frame)
    if rolling_type == "skew":
        raw = F.skewness(c).over(frame)
        return F.when(n >= 3, raw * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    if rolling_type == "kurt":
        raw = F.kurtosis(c).over(frame)
        scale = F.try_divide(n - 1, (n - 2) * (n - 3))
        return F.when(n >= 4, scale * ((n + 1) * raw + 6))
    if rolling_type in ("corr", "cov"):
        if other is None:
            raise OperatorError(f"{rolling_type} needs a second column")
        both = c.isNotNull() & other.isNotNull()
        pair = (F.when(both, c), F.when(both, other))
        if rolling_type == "corr":
            spread = F.sqrt(F.var_pop(pair[0]).over(frame) * F.var_pop(pair[1]).over(frame))
            return F.try_divide(F.covar_pop(*pair).over(frame), spread)
        return F.covar_samp(*pair).over(frame)
    raise OperatorError(f"unknown rolling type: {rolling_type}")


def rolling(
    df: DataFrame,
    rolling_type: str,
    columns: dict[str, str],
    window: int,
    order: str | Sequence = (),
    keys: Sequence[str] = (),
    min_periods: int | None = None,
    center: bool = False,
    win_type: str | None = None,
    rolling_type_options: dict | None = None,
    other: str | None = None,
    row_level: bool = True,
) -> DataFrame:
    """Rolling statistic over ``window`` rows; the first ``min_periods - 1`` rows are cut."""
    require(df, [*columns, *keys])
    if not window or window < 1:
        raise OperatorError("the window must be at least one row")
    order, options = _order(order), rolling_type_options or {}
    least = window if min_periods is None else min_periods
    back, ahead = (window // 2, window - window // 2 - 1) if center else (window - 1, 0)

    def value(name: str, over) -> Column:
        c = col(name).cast("double")
        frame = over.rowsBetween(-back, ahead)
        if win_type is not None:
            result = _weighted(rolling_type, c, over, window, back, win_type)
        else:
            result = rolling_value(rolling_type, c, frame, options, col(other).cast("double") if other else None)
        known = F.count(c).over(frame)
        return F.when(known >= least, result)

    if row_level:
        make = {f"__r{i}": (lambda w, n=n: value(n, w)) for i, n in enumerate(columns)}
        done = sliding(df, keys, order, make, back, ahead, position="__row")
        values = {dst: F.col(f"__r{i}") for i, dst in enumerate(columns.values())}
    else:
        over = Window.partitionBy(*[col(k) for k in keys]).orderBy(*sort_columns(order))
        done = df.select("*", F.row_number().over(over).alias("__row"))
        values = {dst: value(n, over) for n, dst in columns.items()}
    out = done.select(*_replace(df, values), "__row")
    if least > 1:
        out = out.filter(F.col("__row") >= least)
    return out.drop("__row")


def _weighted(rolling_type: str, c: Column, over, window: int, back: int, win_type: str) -> Column:
    if win_type not in ("triang", "boxcar"):
        raise OperatorError(f"window type {win_type} is not offered")
    if rolling_type not in ("sum", "mean"):
        raise OperatorError("weighted windows offer sum and mean")
    weights = []
    for i in range(window):
        if win_type == "boxcar":
            weights.append(1.0)
        else:
            half = (window + 1) / 2
            k = i + 1 if i + 1 <= half else window - i
            weights.append(k / half if window % 2 else (2 * k - 1) / window)
    terms = [F.lag(c, back - i).over(over) * w for i, w in enumerate(weights)]
    present = [F.when(F.lag(c, back - i).over(over).isNotNull(), F.lit(w)).otherwise(0.0) for i, w in enumerate(weights)]
    total = reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0.0)) for t in terms])
    return total if rolling_type == "sum" else F.try_divide(total, reduce(lambda a, b: a + b, present))


# --- resample --------------------------------------------------------------

# Resampling rules and their steps.
_RULES = {
    "S": "second", "s": "second", "T": "minute", "min": "minute", "H": "hour", "h": "hour",
    "D": "day", "W": "week", "MS": "month", "QS": "quarter", "YS": "year", "AS": "year",
}


def parse_rule(rule: str) -> tuple[int, str]:
    digits = "".join(ch for ch in rule if ch.isdigit())
    unit = rule[len(digits):]
    if unit not in _RULES:
        raise OperatorError(f"unknown resampling rule: {rule}")
    return int(digits or 1), _RULES[unit]


def _floor_time(c: Column, amount: int, unit: str) -> Column:
    if unit in ("month", "quarter", "year", "week") or amount == 1:
        return F.date_trunc(unit, c).cast("timestamp_ntz")
    seconds = amount * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    of_day = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if seconds <= 86400:
        return F.timestamp_add("SECOND", -(of_day % seconds), F.date_trunc("second", c).cast("timestamp_ntz"))
    return F.date_trunc("day", c).cast("timestamp_ntz")


def resample(
    df: DataFrame,
    time: str,
    rule: str,
    method: str,
    keys: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    fill_value: float | None = None,
) -> DataFrame:
    """Put every series on a regular time grid spanning the whole frame."""
    if method not in ("asfreq", "bfill", "ffill", "linear", "median", "mean", "sum"):
        raise OperatorError(f"unknown resampling method: {method}")
    require(df, [time, *keys])
    amount, unit = parse_rule(rule)
    chosen = list(columns) if columns else [c for c in df.columns if c not in (time, *keys)]
    numeric = set(_numeric(df))
    df = df.withColumn(time, col(time).cast("timestamp_ntz"))
    ends = total_row(
        df, {"lo": _floor_time(F.min(col(time)), amount, unit), "hi": _floor_time(F.max(col(time)), amount, unit)}
    )
    series = df.select(*keys).distinct() if keys else df.select(F.lit(1).alias("__one")).limit(1)
    numbered = _grid(series, keys, ends, amount, unit, time)
    grid = numbered.drop("__i")
    if method in ("mean", "median", "sum"):
        place = _floor_time(col(time), amount, unit) if amount == 1 or unit in ("second", "minute", "hour") else (
            _bucket_from(col(time), ends.getField("lo"), amount, unit)
        )
        bucketed = df.withColumn(time, place)
        if method == "median":
            found = None
            for c in [c for c in chosen if c in numeric]:
                part = exact_quantiles(bucketed, [*keys, time], c, {c: 0.5})
                found = part if found is None else null_safe_join(found, part, [*keys, time], "full")
        else:
            fn = F.avg if method == "mean" else F.sum
            found = bucketed.groupBy(*keys, time).agg(*[fn(col(c)).alias(c) for c in chosen if c in numeric])
        out = null_safe_join(grid, found, [*keys, time])
        empty = 0 if method == "sum" else None
        empty = fill_value if fill_value is not None else empty
        if empty is not None:
            out = out.select(
                *[F.coalesce(col(c), F.lit(empty)).alias(c) if c in numeric and c in chosen else col(c) for c in out.columns]
            )
        return out
    if method in ("ffill", "bfill"):
        marked = df.select(*keys, time, *chosen, F.lit(False).alias("__grid")).unionByName(
            grid.withColumn("__grid", F.lit(True)), allowMissingColumns=True
        )
        # rows before grid points of the same time, forwards or backwards in time
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col(time))
        placed = marked.withColumns(
            {"__at": micros if method == "ffill" else -micros, "__mark": F.col("__grid").cast("int")}
        )
        order = [("__at", True), ("__mark", True)]
        filled = running(placed, keys, order, {c: Running("fill_forward", c) for c in chosen})
        return filled.filter("__grid").select(*keys, time, *chosen)
    joined = null_safe_join(numbered, df.select(*keys, time, *chosen), [*keys, time])
    if method == "asfreq":
        found = joined.drop("__i")
        if fill_value is None:
            return found
        return found.select(
            *[F.coalesce(col(c), F.lit(fill_value)).alias(c) if c in numeric and c in chosen else col(c) for c in found.columns]
        )
    # The last known and the next known (place, value), each carried from chunk to chunk.
    filled = [c for c in chosen if c in numeric]
    known = {f"__{side}{k}": F.when(col(c).isNotNull(), F.struct(F.col("__i").alias("i"), col(c).cast("double").alias("v"))) for k, c in enumerate(filled) for side in ("left", "right")}
    placed = joined.withColumns({**known, "__back": -F.col("__i")})
    for side, order in (("left", "__i"), ("right", "__back")):
        placed = running(placed, keys, [(order, True)], {f"__{side}{k}": Running("fill_forward", f"__{side}{k}") for k in range(len(filled))}) if filled else placed
    values = {}
    for k, c in enumerate(filled):
        left, right = F.col(f"__left{k}"), F.col(f"__right{k}")
        part = F.try_divide((F.col("__i") - left["i"]).cast("double"), (right["i"] - left["i"]).cast("double"))
        between = left["v"] + (right["v"] - left["v"]) * part
        values[c] = F.when(left.isNull(), F.lit(None)).when(
            right.isNull() | (left["i"] == right["i"]), left["v"]
        ).otherwise(between)
    return placed.select(*_replace(joined.drop("__i"), values))


#: Times of a grid that are spelled out from one row.
GRID_ROWS = 1 << 16


def _grid(series: DataFrame, keys: Sequence[str], ends: Column, amount: int, unit: str, time: str) -> DataFrame:
    """Every series at every time from ``lo`` to ``hi`` of ``ends``, numbered from 0 in ``__i``.

    A row per stretch of the grid comes first and is dealt out with the
    series, so the times of a long grid are never one value.
    """
    months = {"month": 1, "quarter": 3, "year": 12}.get(unit)
    size, step = (amount * months, "MONTH") if months else (amount, unit.upper())
    last = F.floor(F.timestamp_diff(step, ends.getField("lo"), ends.getField("hi")) / size).cast("bigint")
    stretch = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / GRID_ROWS).cast("bigint")))
    kept = [col(k) for k in keys]
    begun = series.select(*kept, stretch.alias("__stretch"), last.alias("__last"))
    room = F.least(F.lit(GRID_ROWS - 1).cast("bigint"), F.col("__last") - F.col("__stretch") * GRID_ROWS)
    numbered = begun.select(*kept, "__stretch", F.explode(F.sequence(F.lit(0).cast("bigint"), room)).alias("__in"))
    numbered = numbered.select(*kept, (F.col("__stretch") * GRID_ROWS + F.col("__in")).alias("__i"))
    return numbered.select(*kept, "__i", F.timestamp_add(step, (F.col("__i") * size).cast("int"), ends.getField("lo")).alias(time))


def _bucket_from(c: Column, origin: Column, amount: int, unit: str) -> Column:
    """Bucket of several days, weeks or months counted from the first grid point."""
    months = {"month": 1, "quarter": 3, "year": 12}.get(unit)
    if months:
        size = amount * months
        passed = F.timestamp_diff("MONTH", origin, c)
        return F.timestamp_add("MONTH", (F.floor(passed / size) * size).cast("int"), origin)
    size = amount * (7 if unit == "week" else 1)
    passed = F.timestamp_diff("DAY", origin, c)
    return F.timestamp_add("DAY", (F.floor(passed / size) * size).cast("int"), origin)


def densify(df: DataFrame, time: str, keys: Sequence[str], fill: dict | None = None) -> DataFrame:
    """Give every series a row at every time that occurs in the frame.

    Meant for bucketed frames: the list of times is one value, so its length is
    checked first.
    """
    if df.select(col(time)).distinct().limit(MAX_TIMES + 1).count() > MAX_TIMES:
        raise OperatorError("too many times; bucket them by a grain first")
    times = df.agg(F.array_sort(F.collect_set(col(time))).alias("t")).scalar()
    grid = df.select(*keys).distinct().select(*[col(k) for k in keys], F.explode(times).alias(time))
    out = null_safe_join(grid, df, [*keys, time])
    return out.fillna(fill) if fill else out


# --- shape -----------------------------------------------------------------


def rename(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rename labels; refused when all the new names exist already."""
    if not columns:
        return df
    if set(columns.values()) <= set(df.columns):
        raise OperatorError("the new labels already exist")
    return df.withColumnsRenamed({k: v for k, v in columns.items() if k in df.columns})


def select(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    require(df, [*(columns or []), *(exclude or [])])
    if columns:
        df = df.select(*[col(c) for c in columns])
    if exclude:
        df = df.drop(*exclude)
    if rename:
        require(df, list(rename))
        df = df.withColumnsRenamed(rename)
    return df


def sort(df: DataFrame, by: str | Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Order by columns, nulls last both ways."""
    names = [by] if isinstance(by, str) else list(by)
    require(df, names)
    ups = [ascending] * len(names) if isinstance(ascending, bool) else list(ascending)
    return df.orderBy(*[col(n).asc_nulls_last() if up else col(n).desc_nulls_last() for n, up in zip(names, ups)])


def flatten(df: DataFrame, labels: dict[str, Sequence[object]], drop_levels: Sequence[int] = ()) -> DataFrame:
    """Give columns that stand for several levels one flat label each."""
    return df.withColumnsRenamed({name: flat_label(levels, drop_levels) for name, levels in labels.items()})


# --- points ----------------------------------------------------------------


def geohash_decode(df: DataFrame, geohash: str, longitude: str, latitude: str, strict: bool = True) -> DataFrame:
    require(df, [geohash])
    out = df.withColumn("__p", geo.decode(col(geohash), strict))
    return out.select(*_replace(df, {latitude: F.col("__p.latitude"), longitude: F.col("__p.longitude")}))


def geohash_encode(df: DataFrame, geohash: str, longitude: str, latitude: str) -> DataFrame:
    require(df, [longitude, latitude])
    return df.select(*_replace(df, {geohash: geo.encode(col(latitude), col(longitude))}))


def geodetic_parse(
    df: DataFrame, geodetic: str, longitude: str, latitude: str, altitude: str | None = None
) -> DataFrame:
    require(df, [geodetic])
    out = df.withColumn("__p", geo.parse_point(col(geodetic)))
    values = {latitude: F.col("__p.latitude"), longitude: F.col("__p.longitude")}
    if altitude:
        values[altitude] = F.col("__p.altitude")
    return out.select(*_replace(df, values))


def _pivot(df: DataFrame, **options) -> DataFrame:
    from .pivots import pivot

    return pivot(df, **options)


def _forecast(df: DataFrame, **options) -> DataFrame:
    from .forecast import forecast

    return forecast(df, **options)


OPERATORS = {
    "aggregate": aggregate,
    "boxplot": boxplot,
    "compare": compare,
    "contribution": contribution,
    "cum": cum,
    "diff": diff,
    "flatten": flatten,
    "forecast": _forecast,
    "geodetic_parse": geodetic_parse,
    "geohash_decode": geohash_decode,
    "geohash_encode": geohash_encode,
    "pivot": _pivot,
    "rename": rename,
    "resample": resample,
    "rolling": rolling,
    "select": select,
    "sort": sort,
}
