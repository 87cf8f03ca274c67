"""Data transforms behind the analytic charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .ordered import Running, null_safe_join, running
from .postprocess import OperatorError, col, total_row

TOTAL = "Total"


def histogram(
    df: DataFrame,
    column: str,
    bins: int = 15,
    groupby: Sequence[str] = (),
    normalized: bool = False,
    cumulative: bool = False,
) -> DataFrame:
    """Counts in equal-width bins over the whole range; the last bin is closed."""
    keys = list(groupby)
    v = col(column).cast("double")
    known = df.filter(col(column).isNotNull())
    ends = total_row(known, {"lo": F.min(v), "hi": F.max(v)})
    lo, hi = ends.getField("lo"), ends.getField("hi")
    place = F.coalesce(F.try_divide(v - lo, hi - lo), F.lit(0.0)) * bins
    index = F.least(F.floor(place).cast("int"), F.lit(bins - 1))
    counts = known.groupBy(*[col(k) for k in keys], index.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    groups = counts.select(*[col(k) for k in keys]).distinct() if keys else known.limit(1).select(F.lit(1).alias("__one"))
    grid = groups.select(*[col(k) for k in keys], F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = null_safe_join(grid, counts, [*keys, "bin"])
    out = out.withColumn("count", F.coalesce(F.col("count"), F.lit(0)))
    # from here on one row per group and bin
    per_group = Window.partitionBy(*[col(k) for k in keys])
    value = F.col("count").cast("double") if normalized else F.col("count")
    if normalized:
        value = F.try_divide(value, F.sum("count").over(per_group))
    out = out.withColumn("value", value)
    if cumulative:
        to_here = per_group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("value", F.sum("value").over(to_here))
    width = (hi - lo) / bins
    return out.select(
        *[col(k) for k in keys],
        "bin",
        (lo + F.col("bin") * width).alias("x0"),
        (lo + (F.col("bin") + 1) * width).alias("x1"),
        "value",
    )


def waterfall(df: DataFrame, x: str, metric: str, breakdown: str | None = None) -> DataFrame:
    """Steps of a waterfall with the running level before and after each.

    With a breakdown every period ends in a ``Total`` row; without one a single
    final ``Total`` row follows.
    """
    value = F.sum(F.coalesce(col(metric), F.lit(0.0)))
    period = col(x).cast("string")
    if breakdown:
        part = F.coalesce(col(breakdown).cast("string"), F.lit("NULL"))
        src = df.select(period.alias(x), part.alias(breakdown), col(metric))
        rows = src.groupingSets([[col(x), col(breakdown)], [col(x)]], col(x), col(breakdown)).agg(
            value.alias(metric), F.grouping(col(breakdown)).cast("int").alias("__total")
        )
        rows = rows.withColumn(breakdown, F.when(F.col("__total") == 1, F.lit(TOTAL)).otherwise(col(breakdown)))
    else:
        src = df.select(period.alias(x), col(metric))
        rows = src.groupingSets([[col(x)], []], col(x)).agg(
            value.alias(metric), F.grouping(col(x)).cast("int").alias("__total")
        )
        rows = rows.withColumn(x, F.when(F.col("__total") == 1, F.lit(TOTAL)).otherwise(col(x)))
    step = F.when(F.col("__total") == 0, col(metric)).otherwise(F.lit(0.0))
    keyed = rows.withColumn("__step", step)
    order = [("__total", True), (x, True)] if not breakdown else [(x, True), ("__total", True), (breakdown, True)]
    done = running(keyed, [], order, {"level_after": Running("sum", "__step")})
    before = F.when(F.col("__total") == 1, F.lit(0.0)).otherwise(F.col("level_after") - col(metric))
    names = [x, breakdown] if breakdown else [x]
    return done.select(
        *[col(n) for n in names],
        col(metric),
        before.alias("level_before"),
        "level_after",
        (F.col("__total") == 1).alias("is_total"),
    )


def tree_rollup(df: DataFrame, levels: Sequence[str], metric: str, secondary: str | None = None) -> DataFrame:
    """Every node of the hierarchy with the sum of its leaves and its depth."""
    def number(name: str) -> Column:
        return F.coalesce(col(name).try_cast("double"), F.lit(0.0))

    shown = df.select(
        *[F.coalesce(col(level).cast("string"), F.lit("NULL")).alias(level) for level in levels],
        number(metric).alias("__m"),
        *([number(secondary).alias("__s")] if secondary else []),
    )
    rolled = shown.rollup(*[col(level) for level in levels]).agg(
        F.sum("__m").alias("value"),
        *([F.sum("__s").alias("secondary_value")] if secondary else []),
        sum((1 - F.grouping(col(level)).cast("int") for level in levels), F.lit(0)).alias("depth"),
    )
    return rolled.filter(F.col("depth") > 0)


def edge_totals(df: DataFrame, source: str, target: str, value: str) -> DataFrame:
    """Links with a value; links of zero or null weight are skipped."""
    kept = df.filter(col(value).isNotNull() & (col(value) != 0))
    return kept.select(col(source).alias("source"), col(target).alias("target"), col(value).alias("value"))


def node_totals(df: DataFrame, source: str, target: str, value: str) -> DataFrame:
    """Total of the incident link values per node; a self-loop counts twice."""
    edges = edge_totals(df, source, target, value)
    ends = edges.select(F.explode(F.array("source", "target")).alias("node"), "value")
    return ends.groupBy("node").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("links"))


def funnel(df: DataFrame, step: str, value: str) -> DataFrame:
    """Share of the first step, the step before and the total, largest step first."""
    ways = running(
        df.select(col(step), col(value)),
        [],
        [(value, False), (step, True)],
        {"position": Running("row_number")},
    )
    top = df.agg(F.max(col(value)).alias("m")).scalar()
    total = df.agg(F.sum(col(value)).alias("s")).scalar()
    earlier = ways.select((F.col("position") + 1).alias("__next"), col(value).alias("__earlier"))
    return ways.join(earlier, F.col("position") == F.col("__next"), "left").select(
        col(step),
        col(value),
        "position",
        F.try_divide(col(value), top).alias("share_of_first"),
        F.coalesce(F.try_divide(col(value), F.col("__earlier")), F.lit(1.0)).alias("share_of_previous"),
        F.try_divide(col(value), total).alias("share_of_total"),
    )


def pie_share(df: DataFrame, name: str, metric: str) -> DataFrame:
    total = df.agg(F.sum(col(metric)).alias("s")).scalar()
    return df.select(
        col(name), col(metric), F.try_divide(col(metric), total).alias("share"), total.alias("total")
    ).orderBy(col(metric).desc_nulls_last(), col(name).asc())


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    tiny, f, c, d = 1e-300, 1.0, 1.0, 0.0
    for i in range(400):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / (1.0 + term * d if abs(1.0 + term * d) > tiny else tiny)
        c = 1.0 + term / (c if abs(c) > tiny else tiny)
        f *= c * d
        if abs(1.0 - c * d) < 1e-14:
            break
    return front * (f - 1.0)


def two_sided_p(t: float | None, freedom: float | None) -> float | None:
    """Two-sided p-value of Student's t."""
    if t is None or freedom is None or freedom <= 0 or math.isnan(t):
        return None
    return _incomplete_beta(freedom / 2.0, 0.5, freedom / (freedom + t * t))


def p_value(t: Column, freedom: Column) -> Column:
    """p-values of a few aggregated rows (one per compared series)."""
    @F.pandas_udf("double")
    def compute(ts: pd.Series, fs: pd.Series) -> pd.Series:
        return pd.Series([two_sided_p(None if pd.isna(a) else a, None if pd.isna(b) else b) for a, b in zip(ts, fs)])

    return compute(t, freedom)


def paired_t_test(df: DataFrame, time: str, series: str, value: str, control: str) -> DataFrame:
    """Lift against the control series and the paired test on common times."""
    base = df.select(col(time), col(series).alias("series"), col(value).cast("double").alias("v"))
    control_rows = base.filter(F.col("series") == control).select(col(time).alias("__t"), F.col("v").alias("c"))
    pairs = base.join(control_rows, col(time).eqNullSafe(F.col("__t")), "inner")
    d = F.col("v") - F.col("c")
    sums = pairs.groupBy("series").agg(
        F.sum("v").alias("sv"), F.sum("c").alias("sc"), F.avg(d).alias("md"), F.stddev_samp(d).alias("sd"),
        F.count(d).alias("n"),
    )
    t = F.try_divide(F.col("md"), F.col("sd") / F.sqrt(F.col("n")))
    return sums.filter(F.col("series") != control).select(
        "series",
        F.round(F.try_divide(F.col("sv") - F.col("sc"), F.col("sc")) * 100, 4).alias("lift_percent"),
        t.alias("t_statistic"),
        (F.col("n") - 1).alias("freedom"),
        p_value(t, (F.col("n") - 1).cast("double")).alias("p_value"),
    )


def event_paths(df: DataFrame, entity: str, event: str, time: str, tie: str, minimum: int = 1) -> DataFrame:
    """Prefixes of the event sequences followed by at least ``minimum`` entities.

    A prefix is known by running sums over hashes of its steps and their
    places, so prefixes are counted in one grouping without gathering any
    sequence.  Only the prefixes that stay are then spelled out, from the
    steps of one entity each.
    """
    if minimum < 1:
        raise OperatorError("the minimum must be at least 1")
    placed = running(
        df.select(col(entity).alias("entity"), col(event).alias("event"), col(time), col(tie)),
        ["entity"],
        [(time, True), (tie, True)],
        {"place": Running("row_number")},
    ).select("entity", "event", "place")
    # 40 bits each: the sums of eight million steps fit a bigint
    marks = [F.pmod(F.xxhash64(F.lit(k), "place", "event"), F.lit(1 << 40)).alias(f"h{k}") for k in (1, 2)]
    marked = running(placed.select("*", *marks), ["entity"], [("place", True)], {f"s{k}": Running("sum", f"h{k}") for k in (1, 2)})
    prefixes = marked.groupBy("place", "s1", "s2").agg(F.count(F.lit(1)).alias("entities"), F.min("entity").alias("entity"))
    kept = prefixes.filter(F.col("entities") >= minimum).select("entity", "place", "entities")
    depth = kept.groupBy("entity").agg(F.max("place").alias("deepest"))
    steps = placed.join(depth, "entity").filter(F.col("place") <= F.col("deepest"))
    spelled = steps.groupBy("entity").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "event"))), lambda s: s["event"]).alias("steps"))
    path = F.array_join(F.slice("steps", F.lit(1), F.col("place").cast("int")), " > ")
    return kept.join(spelled, "entity").select(path.alias("path"), "entities", F.col("place").cast("int").alias("depth"))


def calendar_buckets(df: DataFrame, domain: Column, subdomain: Column, value: Column) -> DataFrame:
    return df.groupBy(domain.alias("domain"), subdomain.alias("subdomain")).agg(F.sum(value).alias("value"))


def break_points(df: DataFrame, column: str, buckets: int = 10, points: Sequence[float] | None = None) -> DataFrame:
    """Rows with the index of their bucket: equal width from the data, or the given points."""
    v = col(column).cast("double")
    if points is not None:
        inner = sorted(points)[1:-1]
        index = sum((F.when(v >= p, 1).otherwise(0) for p in inner), F.lit(0))
        return df.withColumn("bucket", F.when(v.isNotNull(), index))
    ends = total_row(df, {"lo": F.min(v), "hi": F.max(v)})
    lo, hi = ends.getField("lo"), ends.getField("hi")
    place = F.floor(F.coalesce(F.try_divide(v - lo, hi - lo), F.lit(0.0)) * buckets)
    return df.withColumn("bucket", F.when(v.isNotNull(), F.least(place.cast("int"), F.lit(buckets - 1))))


#: Lengths in seconds of the smallest slices of time.
SLICES = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def dyadic_slices(first: Column, last: Column, levels: int = 40) -> Column:
    """The numbers from ``first`` to ``last`` as slices of 2^level numbers: at most two of a level.

    An array of ``level`` and ``place`` (the first number by the slice's
    length).  Going up the levels, a slice that has no sibling in the interval
    stands for itself, all others are left to the level above.
    """

    def of(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        low, high = F.ceil(first / size).cast("bigint"), F.floor((last + 1) / size).cast("bigint")
        slice_ = lambda place: F.struct(level.alias("level"), place.alias("place"))
        left = F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), slice_(low))
        right = F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), slice_(high - 1))
        return F.array_compact(F.array(left, right))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), of))


#: Salts, and the longest lengths of slices that are salted: few slices, looked up by very many notes.
SALTS, SALTED_LEVELS = 32, 8


def interval_annotations(
    df: DataFrame,
    time: str,
    annotations: DataFrame,
    width: str = "day",
    columns: Sequence[str] = ("short_descr",),
    totals: dict[str, tuple[str, str | None]] | None = None,
) -> DataFrame:
    """Rows with the annotations whose interval holds their time.

    Time is cut into slices of a ``width``, of two, four and so on.  An
    interval becomes a few of them, two of a length at most, however long it
    is; a row looks up the one slice of every length that some interval has.
    So the range join is an equi-join, and a long note is not written out.  A
    note without an end lasts a moment; one that ends before it begins holds
    nothing.

    With ``totals`` (name to ``count``, ``sum``, ``min`` or ``max`` and a
    column) the rows themselves are not wanted but their totals per
    ``columns``; these come from totals per slice, so no row meets a note.
    """
    if width not in SLICES:
        raise ValueError(f"unknown width of a slice: {width}")
    number = lambda t: F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("second", t).cast("timestamp_ntz")) / SLICES[width])
    begin = F.col("start_dttm").cast("timestamp_ntz")
    end = F.coalesce(F.col("end_dttm").cast("timestamp_ntz"), begin)
    notes = annotations.select(begin.alias("__begin"), end.alias("__end"), *columns).where("__end >= __begin")
    t = col(time).cast("timestamp_ntz")
    if totals is not None:
        return _interval_totals(df.withColumn("__t", t), notes, list(columns), totals)
    spread = notes.select("*", F.explode(dyadic_slices(number(F.col("__begin")), number(F.col("__end")))).alias("__slice"))
    # One number per length that occurs, 41 at most.
    used = sorted(r[0] for r in spread.select("__slice.level").distinct().collect())
    own = F.array(*[F.struct(F.lit(k).alias("level"), F.floor(number(t) / (1 << k)).alias("place")) for k in used])
    sliced = df.withColumn("__of", F.explode(own)) if used else df.withColumn("__of", F.lit(None).cast("struct<level:int,place:bigint>"))
    hit = (F.col("__of") == F.col("__slice")) & (t >= F.col("__begin")) & (t <= F.col("__end"))
    return sliced.join(spread, hit, "inner").select(*[col(c) for c in df.columns], *columns)


def _interval_totals(df: DataFrame, notes: DataFrame, columns: list[str], totals: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Totals of the rows within the notes, per ``columns``.

    Times that occur, as the time of a row or an end of a note, are numbered in
    their order.  Then a note is a stretch of numbers and as such a few slices,
    without a remainder at its ends, and every slice holds the totals of its rows.
    """
    merge = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    if unknown := {how for how, _ in totals.values()} - set(merge):
        raise ValueError(f"unknown totals: {sorted(unknown)}")
    # Column names of the notes and the totals may be alike.
    inner = {name: f"__total{i}" for i, name in enumerate(totals)}
    first = [
        {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[how](F.lit(1) if c is None else col(c)).alias(inner[name])
        for name, (how, c) in totals.items()
    ]
    again = [merge[how](inner[name]).alias(inner[name]) for name, (how, _) in totals.items()]
    per_time = materialise(df.where("__t IS NOT NULL").groupBy("__t").agg(*first), "per-time")
    notes = materialise(notes.groupBy("__begin", "__end", *[col(c) for c in columns]).agg(F.count(F.lit(1)).alias("__copies")), "notes")
    times = per_time.select("__t").union(notes.select("__begin")).union(notes.select("__end")).distinct()
    placed = materialise(running(materialise(times, "times"), [], [("__t", True)], {"__i": Running("row_number")}), "places")
    a = placed.select(F.col("__t").alias("__begin"), F.col("__i").alias("__first"))
    b = placed.select(F.col("__t").alias("__end"), F.col("__i").alias("__last"))
    spread = materialise(
        notes.join(a, "__begin").join(b, "__end").select(
            *[col(c) for c in columns], "__copies", F.explode(dyadic_slices(F.col("__first"), F.col("__last"))).alias("__s")
        ).select(*[col(c) for c in columns], "__copies", "__s.level", "__s.place", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("__salt")),
        "slices",
    )
    used = sorted(r[0] for r in spread.select("level").distinct().collect())
    salted = F.col("level") > max(used, default=0) - SALTED_LEVELS
    own = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(F.col("__i"), k).alias("place")) for k in used or [0]])
    cells = per_time.join(placed, "__t").select(*inner.values(), F.explode(own).alias("__of")).groupBy("__of").agg(*again)
    cells = cells.select(*inner.values(), "__of.level", "__of.place").withColumn(
        "__salt", F.explode(F.when(salted, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    )
    held = spread.withColumn("__salt", F.when(salted, F.col("__salt")).otherwise(F.lit(0))).join(cells, ["level", "place", "__salt"])
    times_over = lambda how, c: c * F.col("__copies") if how in ("count", "sum") else c
    return held.groupBy(*[col(c) for c in columns]).agg(
        *[merge[how](times_over(how, F.col(inner[name]))).alias(name) for name, (how, _) in totals.items()]
    )


def formula_series(df: DataFrame, x: str, formula: str, label: str) -> DataFrame:
    """``label`` = formula of ``x``, where x is epoch milliseconds for a time."""
    if dict(df.dtypes)[x].startswith("timestamp"):
        number = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col(x)).cast("double")
    else:
        number = col(x).cast("double")
    return df.select("*", number.alias("x")).select(*[col(c) for c in df.columns], F.expr(formula).alias(label))


def series_annotation(df: DataFrame, time: str, other: DataFrame, other_time: str, value: str, label: str) -> DataFrame:
    """Attach the value of another request's series by time."""
    right = other.select(col(other_time).alias("__t"), col(value).alias(label))
    return df.join(right, col(time).eqNullSafe(F.col("__t")), "left").drop("__t")


def heatmap_share(df: DataFrame, x: str, y: str, value: str, across: str = "heatmap") -> DataFrame:
    """Share of the value range and percent rank over the grid, each x or each y."""
    keys = [] if across == "heatmap" else [x if across == "x" else y]
    ranked = running(df, keys, [(value, True)], {"rank": Running("percent_rank")})
    stats = df.groupBy(*[col(k) for k in keys]).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    if keys:
        joined = null_safe_join(ranked, stats, keys)
        lo, hi = F.col("__lo"), F.col("__hi")
    else:
        joined = ranked
        ends = stats.select(F.struct("__lo", "__hi").alias("t")).scalar()
        lo, hi = ends.getField("__lo"), ends.getField("__hi")
    share = F.coalesce(F.try_divide(col(value) - lo, hi - lo), F.lit(0.0))
    return joined.select(*[col(c) for c in df.columns], share.alias("perc"), "rank")


def partition_levels(
    df: DataFrame, levels: Sequence[str], metric: str, time: str | None = None, option: str = "sum",
    start: Column | None = None, end: Column | None = None,
) -> DataFrame:
    """Hierarchy with a time option: sum or mean over time, or the change between two points."""
    shown = [F.coalesce(col(level).cast("string"), F.lit("NULL")).alias(level) for level in levels]
    m = F.coalesce(col(metric).cast("double"), F.lit(0.0))
    depth = sum((1 - F.grouping(col(level)).cast("int") for level in levels), F.lit(0)).alias("depth")
    if option in ("sum", "mean"):
        if option == "mean":
            src = df.select(*shown, col(time).alias("__t"), m.alias("__m"))
            # mean over time of the per-time sums; times counted over the whole frame
            times = df.agg(F.count_distinct(col(time)).alias("n")).scalar()
            rolled = src.rollup(*[col(level) for level in levels]).agg(F.sum("__m").alias("__sum"), depth)
            out = rolled.withColumn("value", F.try_divide(F.col("__sum"), times)).drop("__sum")
        else:
            src = df.select(*shown, m.alias("__m"))
            out = src.rollup(*[col(level) for level in levels]).agg(F.sum("__m").alias("value"), depth)
    else:
        src = df.select(*shown, F.when(start, m).alias("__a"), F.when(end, m).alias("__b"))
        rolled = src.rollup(*[col(level) for level in levels]).agg(
            F.coalesce(F.sum("__a"), F.lit(0.0)).alias("__a"), F.coalesce(F.sum("__b"), F.lit(0.0)).alias("__b"), depth
        )
        a, b = F.col("__a"), F.col("__b")
        ways = {"point_diff": b - a, "point_percent": F.try_divide(b - a, a), "point_factor": F.try_divide(b, a)}
        if option not in ways:
            raise OperatorError(f"unknown time option: {option}")
        out = rolled.withColumn("value", ways[option]).drop("__a", "__b")
    return out.filter(F.col("depth") > 0)


def chord_flows(df: DataFrame, source: str, target: str, value: str) -> DataFrame:
    """Flow of every linked ordered pair; pairs without a link mean 0 and are not written out."""
    return df.groupBy(col(source).alias("source"), col(target).alias("target")).agg(F.sum(col(value)).alias("flow"))


def chord_nodes(flows: DataFrame) -> DataFrame:
    """Nodes in name order with their 0-based place in the matrix."""
    nodes = flows.select(F.explode(F.array("source", "target")).alias("node")).distinct()
    placed = running(nodes, [], [("node", True)], {"__i": Running("row_number")})
    return placed.select("node", (F.col("__i") - 1).alias("place"))


def chord_matrix(df: DataFrame, source: str, target: str, value: str) -> DataFrame:
    """Square matrix in sparse form: row and column place with the flow."""
    flows = chord_flows(df, source, target, value)
    nodes = chord_nodes(flows)
    rows = nodes.select(F.col("node").alias("__a"), F.col("place").alias("row"))
    cols = nodes.select(F.col("node").alias("__b"), F.col("place").alias("col"))
    return (
        flows.join(rows, F.col("source") == F.col("__a"))
        .join(cols, F.col("target") == F.col("__b"))
        .select("source", "target", "row", "col", "flow")
    )
