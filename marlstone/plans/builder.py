"""From a request to one lazy DataFrame."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timerange
from ..functions.labels import unique
from .filters import apply_filters, between
from .request import TIME_LABEL, Dataset, Dim, Metric, Request, RequestError, label_of, page_size


def validate(dataset: Dataset, request: Request) -> None:
    labels = [label_of(c) for c in request.columns] + [label_of(m) for m in request.metrics or ()]
    repeated = {x for x in labels if labels.count(x) > 1}
    if repeated:
        raise RequestError(f"duplicate labels: {', '.join(sorted(repeated))}")
    unknown = [s for s in request.series_columns if s not in [label_of(c) for c in request.columns]]
    if unknown:
        raise RequestError(f"series columns must be columns of the request: {', '.join(unknown)}")


def bounds(request: Request, now: datetime) -> tuple[datetime | None, datetime | None]:
    if not request.time_range:
        return None, None
    return timerange.resolve(request.time_range, now, request.time_shift)


def filtered(dataset: Dataset, request: Request, now: datetime, span=None) -> DataFrame:
    """Rows of the dataset after filters, time range and the free WHERE text."""
    df = apply_filters(dataset, dataset.df, request.filters, now)
    axis = request.time_column or dataset.time_column
    since, until = span if span is not None else bounds(request, now)
    if axis and (since or until):
        df = df.filter(between(F.col(f"`{axis}`"), dataset.dtype(axis), since, until))
    if request.where:
        df = df.filter(F.expr(request.where))
    return df


def all_columns(request: Request) -> list[str | Dim]:
    columns = list(request.columns)
    if request.is_timeseries and TIME_LABEL not in [label_of(c) for c in columns]:
        columns.insert(0, TIME_LABEL)
    return columns


def aggregated(dataset: Dataset, request: Request, now: datetime, span=None) -> DataFrame:
    """Group-by of the request, before ordering and limits."""
    validate(dataset, request)
    df = filtered(dataset, request, now, span)
    columns = all_columns(request)
    dims = [dataset.dimension(c, request) for c in columns]
    if request.metrics is None:
        return df.select(*dims) if dims else df
    metrics = [dataset.metric(m) for m in request.metrics]
    if not metrics:
        return df.select(*dims).distinct()
    helper = None
    if request.series_limit and request.series_columns:
        helper = top_series(dataset, request, now)
    labels = [label_of(c) for c in columns]
    needed = df.select("*", *[d.alias(f"__dim{i}") for i, d in enumerate(dims)])
    names = [f"__dim{i}" for i in range(len(dims))]
    if helper is not None:
        on = {label: f"__dim{i}" for i, label in enumerate(labels)}
        kept = helper.select(*[F.col(f"`{s}`").alias(f"__s_{s}") for s in request.series_columns])
        match = F.lit(True)
        for s in request.series_columns:
            match = match & F.col(on[s]).eqNullSafe(F.col(f"`__s_{s}`"))
        needed = needed.join(kept, match, "left_semi")
    out = needed.groupBy(*names).agg(*metrics)
    out = out.select(
        *[F.col(n).alias(label) for n, label in zip(names, labels)],
        *[F.col(f"`{label_of(m)}`") for m in request.metrics],
    )
    if request.having:
        out = out.filter(F.expr(request.having))
    return out


def top_series(dataset: Dataset, request: Request, now: datetime) -> DataFrame:
    """The best series by a metric over the main range; ties are cut by series name."""
    ranker = request.series_limit_metric or request.metrics[0]
    label = label_of(ranker)
    df = filtered(dataset, request, now)
    wanted = [c for c in request.columns if label_of(c) in request.series_columns]
    dims = [dataset.dimension(c, request).alias(label_of(c)) for c in wanted]
    totals = (
        df.select("*", *[d.alias(f"__dim{i}") for i, d in enumerate(dims)])
        .groupBy(*[f"__dim{i}" for i in range(len(dims))])
        .agg(dataset.metric(ranker).alias(label))
        .select(
            *[F.col(f"__dim{i}").alias(label_of(c)) for i, c in enumerate(wanted)],
            F.col(f"`{label}`").alias("__rank_value"),
        )
    )
    value = F.col("__rank_value")
    first = value.desc_nulls_last() if request.order_desc else value.asc_nulls_last()
    names = [F.col(f"`{label_of(c)}`").asc_nulls_last() for c in wanted]
    return totals.orderBy(first, *names).limit(request.series_limit).drop("__rank_value")


def ordered(df: DataFrame, request: Request) -> DataFrame:
    """Order, offset and limit."""
    order = list(request.order_by)
    if not order and request.metrics:
        order = [(label_of(request.metrics[0]), not request.order_desc)]
    if order and (request.row_limit or request.row_offset or request.order_by):
        named = {n for n, _ in order}
        ties = [(c, True) for c in df.columns if c not in named and c not in _metric_labels(request)]
        df = df.orderBy(
            *[
                F.col(f"`{n}`").asc_nulls_last() if up else F.col(f"`{n}`").desc_nulls_last()
                for n, up in [*order, *ties]
            ]
        )
    if request.row_offset:
        df = df.offset(request.row_offset)
    if request.row_limit:
        df = df.limit(request.row_limit)
    return df


def _metric_labels(request: Request) -> set[str]:
    return {label_of(m) for m in request.metrics or ()}


def compile_request(dataset: Dataset, request: Request, now: datetime) -> DataFrame:
    """The whole request: grouping, order, time offsets, then the listed operators."""
    if request.time_offsets:
        from ..operators.comparison import with_offsets

        df = with_offsets(dataset, request, now)
        df = ordered(df, request)
    else:
        df = ordered(aggregated(dataset, request, now), request)
    return post_process(df, request)


def post_process(df: DataFrame, request: Request) -> DataFrame:
    from ..operators.postprocess import OPERATORS

    for name, options in request.post_processing:
        if name not in OPERATORS:
            raise RequestError(f"unknown operator: {name}")
        df = OPERATORS[name](df, **options)
    return df


def row_count(dataset: Dataset, request: Request, now: datetime) -> DataFrame:
    """Rows of the answer without its limit."""
    return aggregated(dataset, request, now).agg(F.count(F.lit(1)).alias("rowcount"))


def totals(dataset: Dataset, request: Request, now: datetime) -> DataFrame:
    """The metrics of the request over everything: no columns, no limit."""
    df = filtered(dataset, request, now)
    return df.agg(*[dataset.metric(m) for m in request.metrics])


def with_total_row(dataset: Dataset, request: Request, now: datetime) -> DataFrame:
    """Groups and the grand total from one scan; ``is_total`` marks the extra row."""
    columns = all_columns(request)
    df = filtered(dataset, request, now)
    needed = df.select("*", *[dataset.dimension(c, request).alias(f"__dim{i}") for i, c in enumerate(columns)])
    names = [F.col(f"__dim{i}") for i in range(len(columns))]
    metrics = [dataset.metric(m) for m in request.metrics]
    sets = needed.groupingSets([names, []], *names).agg(*metrics, F.grouping_id().alias("__level"))
    return sets.select(
        *[F.col(f"__dim{i}").alias(label_of(c)) for i, c in enumerate(columns)],
        *[F.col(f"`{label_of(m)}`") for m in request.metrics],
        (F.col("__level") > 0).alias("is_total"),
    )


def samples(
    dataset: Dataset,
    request: Request,
    now: datetime,
    sort_key: list[str],
    page: int = 1,
    per_page: int | None = None,
    drill: bool = False,
) -> DataFrame:
    """A page of raw rows; samples ignore the time range, drill-to-detail keeps it."""
    if not sort_key:
        raise RequestError("pages need a sort key")
    size = page_size(per_page)
    df = filtered(dataset, request, now) if drill else filtered(dataset, request, now, span=(None, None))
    return df.orderBy(*[F.col(f"`{k}`").asc_nulls_last() for k in sort_key]).offset((page - 1) * size).limit(size)


def distinct_values(dataset: Dataset, column: str, limit: int | None = None) -> DataFrame:
    """Distinct values, nulls included."""
    if column not in dataset.columns:
        raise RequestError(f"column missing in dataset: {column}")
    df = dataset.df.select(F.col(f"`{column}`")).distinct()
    return df.limit(limit) if limit else df


def filter_options(
    dataset: Dataset,
    column: str,
    search: str | None = None,
    sort_metric: str | Metric | None = None,
    ascending: bool = True,
) -> DataFrame:
    """Values a dashboard filter offers, with the metric they are sorted by."""
    df = dataset.df
    if search:
        number = search.replace(".", "", 1).lstrip("-").isdigit()
        if isinstance(dataset.dtype(column), T.StringType) or number:
            df = df.filter(F.col(f"`{column}`").cast("string").ilike(f"%{search}%"))
    key = F.col(f"`{column}`")
    if sort_metric is None:
        return df.select(key).distinct()
    out = df.groupBy(key).agg(dataset.metric(sort_metric))
    rank = F.col(f"`{label_of(sort_metric)}`")
    return out.orderBy(rank.asc_nulls_last() if ascending else rank.desc_nulls_last(), key.asc_nulls_last())


def range_bounds(dataset: Dataset, column: str, request: Request, now: datetime) -> DataFrame:
    c = F.col(f"`{column}`")
    return filtered(dataset, request, now).agg(F.min(c).alias("min"), F.max(c).alias("max"))


def columns_and_types(dataset: Dataset) -> DataFrame:
    """Name, Spark type and generic class of every column."""
    rows = [(f.name, f.dataType.simpleString(), generic_type(f.dataType)) for f in dataset.df.schema.fields]
    return dataset.df.sparkSession.createDataFrame(rows, "name string, type string, generic string")


def generic_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dtype, T.NumericType):
        return "NUMERIC"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "TEMPORAL"
    return "STRING"


def probe(df: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The limited rows, and a one-row frame saying whether more existed."""
    status = df.limit(limit + 1).agg(
        F.when(F.count(F.lit(1)) > limit, F.lit("LIMITED")).otherwise(F.lit("NOT_LIMITED")).alias("limiting")
    )
    return df.limit(limit), status


def side_by_side(first: DataFrame, second: DataFrame, on: list[str]) -> DataFrame:
    """Two answers of a mixed chart next to each other; clashing labels get a suffix."""
    clash = [c for c in second.columns if c in first.columns and c not in on]
    for c in clash:
        first = first.withColumnRenamed(c, f"{c} (query A)")
        second = second.withColumnRenamed(c, f"{c} (query B)")
    left = first.select(*[F.col(f"`{c}`").alias(f"__l_{c}") if c in on else F.col(f"`{c}`") for c in first.columns])
    right = second.select(
        *[F.col(f"`{c}`").alias(f"__k_{c}") if c in on else F.col(f"`{c}`") for c in second.columns]
    )
    match = None
    for c in on:
        test = F.col(f"`__l_{c}`").eqNullSafe(F.col(f"`__k_{c}`"))
        match = test if match is None else match & test
    joined = left.join(right, match, "full")
    return joined.select(
        *[F.coalesce(F.col(f"`__l_{c}`"), F.col(f"`__k_{c}`")).alias(c) for c in on],
        *[F.col(f"`{c}`") for c in left.columns if not c.startswith("__l_")],
        *[F.col(f"`{c}`") for c in right.columns if not c.startswith("__k_")],
    )


# Strptime letters and their Spark patterns with the text length.
_TIME_LETTERS = {
    "%Y": ("yyyy", 4),
    "%m": ("MM", 2),
    "%d": ("dd", 2),
    "%H": ("HH", 2),
    "%M": ("mm", 2),
    "%S": ("ss", 2),
    "%y": ("yy", 2),
}


def parse_time(column, dtype: T.DataType, style: str | None):
    """Time out of epoch seconds, epoch milliseconds, a formatted text or a timestamp."""
    if style == "epoch_s":
        return F.timestamp_seconds(column).cast("timestamp_ntz")
    if style == "epoch_ms":
        return F.timestamp_millis(column.cast("long")).cast("timestamp_ntz")
    if style and isinstance(dtype, T.StringType):
        pattern, length, rest = "", 0, style
        while rest:
            if rest[:2] in _TIME_LETTERS:
                piece, size = _TIME_LETTERS[rest[:2]]
                pattern, length, rest = pattern + piece, length + size, rest[2:]
            else:
                quoted = rest[0] if not rest[0].isalpha() else f"'{rest[0]}'"
                pattern, length, rest = pattern + quoted, length + 1, rest[1:]
        return F.try_to_timestamp(F.substring(column, 1, length), F.lit(pattern)).cast("timestamp_ntz")
    return column.cast("timestamp_ntz")


def normalise(
    df: DataFrame,
    times: dict[str, str | None] | None = None,
    metrics: list[str] | None = None,
    hours: int = 0,
    time_shift: str | None = None,
) -> DataFrame:
    """Parse time columns, add the hour offset and the shift; metrics to numbers; no infinities."""
    changed = {}
    for name, style in (times or {}).items():
        value = parse_time(F.col(f"`{name}`"), df.schema[name].dataType, style)
        if hours:
            value = F.timestamp_add("HOUR", F.lit(hours), value)
        if time_shift:
            amount, unit = timerange.delta_text(time_shift)
            value = F.timestamp_add(unit.upper(), F.lit(abs(amount)), value)
        changed[name] = value
    for field in df.schema.fields:
        wants_number = field.name in (metrics or [])
        if wants_number and isinstance(field.dataType, T.StringType):
            changed[field.name] = no_infinity(F.col(f"`{field.name}`").try_cast("double"))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)) and field.name not in changed:
            changed[field.name] = no_infinity(F.col(f"`{field.name}`"))
    return df.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in df.columns])


def no_infinity(column):
    return F.when(F.abs(column) != F.lit(float("inf")), column)


def expand_nested(df: DataFrame) -> DataFrame:
    """Struct fields as dotted columns; what stays nested becomes JSON text."""

    def leaves(prefix: list[str], dtype: T.DataType):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from leaves([*prefix, f.name], f.dataType)
        else:
            path = ".".join(f"`{p}`" for p in prefix)
            nested = isinstance(dtype, (T.ArrayType, T.MapType))
            yield (F.to_json(F.col(path)) if nested else F.col(path)), ".".join(prefix)

    pairs = [pair for f in df.schema.fields for pair in leaves([f.name], f.dataType)]
    return df.select(*[c for c, _ in pairs]).toDF(*unique([n for _, n in pairs]))


