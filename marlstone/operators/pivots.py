"""Pivots, subtotals, fractions and the order of series."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import flatten as flat_label
from ..functions.labels import unique
from .ordered import Running, null_safe_join, running
from .postprocess import OperatorError, aggregate, col, require
from .quantiles import exact_quantiles

MAX_PIVOT_COLUMNS = 10_000
_SPLIT = "\u0001"
#: Stands before the margin's name in a key, so that no column value can be taken for the margin.
_MARGIN = "\u0002"


def pivot(
    df: DataFrame,
    index: Sequence[str],
    aggregates: dict[str, dict],
    columns: Sequence[str] = (),
    metric_fill_value: float | None = None,
    column_fill_value: str = "<NULL>",
    drop_missing_columns: bool = True,
    combine_value_with_metric: bool = False,
    marginal_distributions: bool = False,
    marginal_distribution_name: str = "All",
) -> DataFrame:
    """Pivot table with one flat label per metric and column value.

    The column values are read first (they become the schema) and refused
    beyond a limit; cells come from one grouping, so nothing is multiplied out.
    """
    index, columns = list(index), list(columns or ())
    if not index:
        raise OperatorError("pivot needs at least one index column")
    if not aggregates:
        raise OperatorError("pivot needs at least one aggregate")
    require(df, [*index, *columns])
    for key in index:
        df = df.filter(col(key).isNotNull())
    if not columns:
        out = aggregate(df, index, aggregates)
        if marginal_distributions:
            texts = df.select(*[col(c).cast("string").alias(c) if c in index else col(c) for c in df.columns])
            out = aggregate(texts, index, aggregates).unionByName(
                _margin_rows(aggregate(df, [], aggregates), index, marginal_distribution_name)
            )
        return _fill(out, list(aggregates), metric_fill_value)
    filled = [F.coalesce(col(c).cast("string"), F.lit(column_fill_value)) for c in columns]
    keyed = df.withColumn("__key", F.concat_ws(_SPLIT, *filled))
    cells = aggregate(keyed, [*index, "__key"], aggregates)
    if marginal_distributions:
        name = marginal_distribution_name
        texts = [col(c).cast("string").alias(c) if c in index else col(c) for c in cells.columns]
        cells = cells.select(*texts)
        right = aggregate(df, index, aggregates).select(
            *[col(c).cast("string").alias(c) for c in index], *[col(a) for a in aggregates], F.lit(_MARGIN + name).alias("__key")
        )
        bottom = _margin_rows(aggregate(keyed, ["__key"], aggregates), index, name)
        corner = _margin_rows(aggregate(df, [], aggregates), index, name).withColumn("__key", F.lit(_MARGIN + name))
        inner, below = cells.unionByName(right), bottom.unionByName(corner)
        cells = inner.withColumn("__below", F.lit(False)).unionByName(below.withColumn("__below", F.lit(True)))
    else:
        cells = cells.withColumn("__below", F.lit(False))
    known = cells.groupBy("__key").agg(*[F.count(col(a)).alias(a) for a in aggregates])
    listed = known.orderBy("__key").limit(MAX_PIVOT_COLUMNS + 1).collect()
    listed.sort(key=lambda r: (r["__key"].removeprefix(_MARGIN), r["__key"].startswith(_MARGIN)))
    if len(listed) > MAX_PIVOT_COLUMNS:
        raise OperatorError("too many column values to pivot; keep the long form")
    wide = cells.groupBy(*index, "__below").pivot("__key", [r["__key"] for r in listed])
    wide = wide.agg(*[F.first(col(a)).alias(a) for a in aggregates])
    single = len(aggregates) == 1
    picked = []
    for a in aggregates:
        for row in listed:
            if drop_missing_columns and metric_fill_value is None and row[a] == 0:
                continue
            levels = row["__key"].removeprefix(_MARGIN).split(_SPLIT)
            label = flat_label([*levels, a] if combine_value_with_metric else [a, *levels])
            source = row["__key"] if single else f"{row['__key']}_{a}"
            value = F.col("`" + source.replace("`", "``") + "`")
            if metric_fill_value is not None:
                value = F.coalesce(value, F.lit(metric_fill_value))
            picked.append((value, label))
    names = unique([label for _, label in picked])
    return wide.select(*[col(i) for i in index], *[value.alias(n) for (value, _), n in zip(picked, names)])


def _margin_rows(df: DataFrame, index: Sequence[str], name: str) -> DataFrame:
    first, rest = index[0], index[1:]
    return df.select(F.lit(name).alias(first), *[F.lit("").alias(i) for i in rest], "*")


def _fill(df: DataFrame, names: Sequence[str], value: float | None) -> DataFrame:
    return df if value is None else df.fillna(value, subset=list(names))


# --- pivot table chart -----------------------------------------------------


def aggregator(name: str, value: Column, order: Column | None = None, denominator: Column | None = None) -> Column:
    """The aggregation functions of the pivot table chart (median: see ``pivot_long``)."""
    known = F.count(value)
    table = {
        "Count": lambda: known,
        "Count Unique Values": lambda: F.count_distinct(value),
        "List Unique Values": lambda: F.array_join(F.array_sort(F.collect_set(value.cast("string"))), ", "),
        "Sum": lambda: F.sum(value),
        "Integer Sum": lambda: F.sum(value.cast("long")),
        "Average": lambda: F.avg(value),
        "Sample Variance": lambda: F.when(known == 1, F.lit(0.0)).otherwise(F.var_samp(value)),
        "Sample Standard Deviation": lambda: F.when(known == 1, F.lit(0.0)).otherwise(F.stddev_samp(value)),
        "Minimum": lambda: F.min(value),
        "Maximum": lambda: F.max(value),
    }
    if name in ("First", "Last"):
        if order is None:
            raise OperatorError(f"{name} needs an order column")
        return F.min_by(value, order) if name == "First" else F.max_by(value, order)
    if name == "Sum over Sum":
        if denominator is None:
            raise OperatorError("Sum over Sum needs a second column")
        return F.try_divide(F.sum(value), F.sum(denominator))
    if name not in table:
        raise OperatorError(f"unknown aggregation function {name}")
    return table[name]()


def pivot_long(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    function: str,
    order: str | None = None,
    denominator: str | None = None,
) -> DataFrame:
    """Cells of a pivot table in long form: keys and ``value``."""
    if function == "Median":
        return exact_quantiles(df, keys, value, {"value": 0.5})
    expression = aggregator(
        function, col(value), col(order) if order else None, col(denominator) if denominator else None
    )
    return df.groupBy(*[col(k) for k in keys]).agg(expression.alias("value"))


def text_dimension(c: Column) -> Column:
    """Dimension value as shown: null is the text NULL."""
    return F.coalesce(c.cast("string"), F.lit("NULL"))


def pivot_table(
    df: DataFrame,
    rows: Sequence[str],
    columns: Sequence[str],
    metrics: Sequence[str],
    function: str = "Sum",
    transpose: bool = False,
    combine_metrics: bool = False,
    metrics_on_rows: bool = False,
) -> DataFrame:
    """Wide pivot table; metrics sit on the columns, or on the rows as ``metric``."""
    if transpose:
        rows, columns = columns, rows
    rows, columns = list(rows), list(columns)
    shown = df.select(
        *[text_dimension(col(c)).alias(c) for c in [*rows, *columns]], *[col(m).cast("double").alias(m) for m in metrics]
    )
    spec = {"Sum": "sum", "Average": "mean", "Minimum": "min", "Maximum": "max", "Count": "count", "Median": "median"}
    if function not in spec:
        raise OperatorError(f"use pivot_long for {function}")
    if metrics_on_rows:
        long = shown.unpivot(
            [col(c) for c in [*rows, *columns]], [col(m) for m in metrics], "metric", "value"
        )
        return pivot(
            long, [*rows, "metric"], {"value": {"column": "value", "operator": spec[function]}}, columns,
            drop_missing_columns=False,
        )
    aggregates = {m: {"column": m, "operator": spec[function]} for m in metrics}
    if not rows:
        return aggregate(shown, columns, aggregates)
    return pivot(
        shown, rows, aggregates, columns, drop_missing_columns=False, combine_value_with_metric=combine_metrics
    )


def subtotals(
    df: DataFrame, rows: Sequence[str], columns: Sequence[str], metrics: dict[str, Column], function: str = "Sum"
) -> DataFrame:
    """Cells, a ``Subtotal`` per level and ``Total (fn)`` overall, from one grouping of the base rows."""
    rows, columns = list(rows), list(columns)

    def prefixes(names: list[str]) -> list[list[str]]:
        return [names[:i] for i in range(len(names), -1, -1)]

    sets = [[*r, *c] for r in prefixes(rows) for c in prefixes(columns)]
    texts = df.select("*", *[text_dimension(col(n)).alias(f"__t_{n}") for n in [*rows, *columns]])
    names = [f"__t_{n}" for n in [*rows, *columns]]
    grouped = texts.groupingSets(
        [[F.col(f"`__t_{n}`") for n in s] for s in sets], *[F.col(f"`{n}`") for n in names]
    ).agg(
        *[c.alias(label) for label, c in metrics.items()],
        *[F.grouping(F.col(f"`{n}`")).cast("int").alias(f"__g{i}") for i, n in enumerate(names)],
    )
    shown = []
    for group, offset in ((rows, 0), (columns, len(rows))):
        for i, n in enumerate(group):
            gone = F.col(f"__g{offset + i}") == 1
            leading = F.lit(f"Total ({function})") if i == 0 else F.when(
                F.col(f"__g{offset + i - 1}") == 0, F.lit("Subtotal")
            ).otherwise(F.lit(""))
            shown.append(F.when(gone, leading).otherwise(F.col(f"`__t_{n}`")).alias(n))
    return grouped.select(*shown, *[col(m) for m in metrics])


def cell_subtotals(
    df: DataFrame, rows: Sequence[str], columns: Sequence[str], metrics: dict[str, Column],
    total: Callable[[Column], Column] = F.avg, function: str = "Average",
) -> DataFrame:
    """As ``subtotals``, with levels computed from the cells instead of the rows: an average of averages.

    For functions that do not add up the two differ.  ``total`` is applied to
    the cells of a row for every level of columns, then to the rows below for
    every level of rows, those column totals included; a cell that no row of
    ``df`` falls into has no part.  The cells themselves stay as they are.

    The rows of ``df`` are grouped once; all else works on cells.
    """
    rows, columns = list(rows), list(columns)
    dims = [f"__t_{n}" for n in [*rows, *columns]]
    texts = df.select("*", *[text_dimension(col(n)).alias(f"__t_{n}") for n in [*rows, *columns]])
    depths = F.lit(len(rows)).alias("__rows"), F.lit(len(columns)).alias("__columns")
    values = {m: f"__m{i}" for i, m in enumerate(metrics)}
    cells = texts.groupBy(*[col(n) for n in dims]).agg(*[c.alias(values[m]) for m, c in metrics.items()]).select("*", *depths)

    def levels(part: DataFrame, group: list[str], depth: str) -> DataFrame:
        """The totals of every shorter beginning of ``group``, all other dimensions kept."""
        names = [f"__t_{n}" for n in group]
        others = [c for c in [*dims, "__rows", "__columns"] if c not in names and c != depth]
        sets = [[col(n) for n in [*others, *names[:i]]] for i in range(len(names))]
        gone = sum((F.grouping(col(n)).cast("int") for n in names), F.lit(0))
        grouped = part.groupingSets(sets, *[col(n) for n in [*others, *names]]).agg(
            *[total(F.col(v)).alias(v) for v in values.values()], (F.lit(len(names)) - gone).alias(depth)
        )
        return part.unionByName(grouped.select(*part.columns))

    whole = levels(cells, columns, "__columns") if columns else cells
    whole = levels(whole, rows, "__rows") if rows else whole

    def shown(group: list[str], depth: str) -> list[Column]:
        out = []
        for i, n in enumerate(group):
            name = F.lit(f"Total ({function})") if i == 0 else F.when(F.col(depth) == i, F.lit("Subtotal")).otherwise(F.lit(""))
            out.append(F.when(F.col(depth) > i, col(f"__t_{n}")).otherwise(name).alias(n))
        return out

    return whole.select(*shown(rows, "__rows"), *shown(columns, "__columns"), *[F.col(v).alias(m) for m, v in values.items()])


def fractions(cells: DataFrame, value: str, axis: str, rows: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Share of each cell in the total, its row or its column."""
    if axis == "total":
        whole = cells.agg(F.sum(value).alias("s")).scalar()
        return cells.withColumn("fraction", F.try_divide(col(value), whole))
    keys = rows if axis == "rows" else columns
    sums = cells.groupBy(*[col(k) for k in keys]).agg(F.sum(value).alias("__sum"))
    joined = null_safe_join(cells, sums, list(keys))
    return joined.withColumn("fraction", F.try_divide(col(value), F.col("__sum"))).drop("__sum")


# --- order -----------------------------------------------------------------


def series_order(df: DataFrame, series: Sequence[str], value: str, by: str = "sum", ascending: bool = False) -> DataFrame:
    """Rank of every series by name or by an aggregate of its values (ties by name)."""
    ways = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}
    if by != "name" and by not in ways:
        raise OperatorError(f"unknown series order: {by}")
    names = [col(s) for s in series]
    score = F.lit(0.0) if by == "name" else ways[by](value)
    ranked = df.groupBy(*names).agg(score.alias("__score"))
    if by == "name":
        order = [(s, ascending) for s in series]
    else:
        order = [("__score", ascending), *[(s, True) for s in series]]
    placed = running(ranked, [], order, {"series_rank": Running("row_number")}).drop("__score")
    return null_safe_join(df, placed, list(series), "inner")


def stack_totals(df: DataFrame, x: str, value: str, threshold: float) -> DataFrame:
    """Total per x and the threshold (percent of it) under which labels are hidden."""
    totals = df.groupBy(col(x)).agg(F.sum(F.coalesce(col(value), F.lit(0.0))).alias("total"))
    return totals.withColumn("threshold", F.lit(threshold) / 100 * F.col("total"))


def axis_sort(df: DataFrame, x: str, by: str | None, ascending: bool, groupby: Sequence[str] = ()) -> DataFrame:
    """Sort by the axis or a metric; only frames without series are sorted."""
    if groupby or not by:
        return df
    require(df, [by])
    return df.orderBy(col(by).asc_nulls_last() if ascending else col(by).desc_nulls_last(), col(x).asc_nulls_last())


def natural_key(c: Column) -> Column:
    """Text key in which runs of digits sort by their number."""
    runs = F.regexp_extract_all(c.cast("string"), F.lit(r"(\d+|\D+)"), 1)

    def padded(run: Column) -> Column:
        short = run.rlike(r"^\d") & (F.length(run) < 20)
        return F.when(short, F.concat(F.substring(F.lit("0" * 20), F.lit(1), 20 - F.length(run)), run)).otherwise(run)

    return F.array_join(F.transform(runs, padded), "")


def pivot_sort(
    df: DataFrame, key: str, value: str, by: str = "key", ascending: bool = True, subtotals_first: bool = False,
    is_subtotal: str | None = None,
) -> DataFrame:
    """Order rows by natural key or by their total; subtotals first or last."""
    order: list[Column] = []
    if is_subtotal:
        order.append(col(is_subtotal).desc() if subtotals_first else col(is_subtotal).asc())
    if by == "value":
        order.append(col(value).asc_nulls_last() if ascending else col(value).desc_nulls_last())
    natural = natural_key(col(key))
    order += [natural.asc() if ascending or by == "value" else natural.desc(), col(key).asc()]
    return df.orderBy(*order)


