"""What an analytics request says: dataset, dimensions, metrics, filters, options."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.grains import bucket

# Page size of raw rows where the caller names none; no other limit is put in.
SAMPLES_LIMIT = 1_000


class RequestError(ValueError):
    """The request cannot be answered as written."""


@dataclass(frozen=True)
class Dim:
    """A dimension: a column, or an SQL expression with a label, optionally bucketed."""

    label: str
    expr: str | None = None
    grain: str | None = None


@dataclass(frozen=True)
class Metric:
    """A metric: an aggregate of a column, or a free SQL aggregate."""

    label: str
    aggregate: str | None = None
    column: str | None = None
    expr: str | None = None


@dataclass(frozen=True)
class Filter:
    column: str
    op: str
    value: object = None
    advanced: str | None = None  # "address" or "port"


@dataclass(frozen=True)
class Rule:
    """A row-level predicate: ``regular`` for the listed roles, ``base`` for all others."""

    clause: str
    roles: frozenset[str]
    kind: str = "regular"
    group: str | None = None


@dataclass(frozen=True)
class Request:
    columns: Sequence[str | Dim] = ()
    metrics: Sequence[str | Metric] | None = ()
    filters: Sequence[Filter] = ()
    time_column: str | None = None
    time_range: str | None = None
    time_shift: str | None = None
    grain: str | None = None
    where: str | None = None
    having: str | None = None
    order_by: Sequence[tuple[str, bool]] = ()
    row_limit: int | None = None
    row_offset: int = 0
    series_columns: Sequence[str] = ()
    series_limit: int = 0
    series_limit_metric: str | Metric | None = None
    order_desc: bool = True
    is_timeseries: bool = False
    time_offsets: Sequence[str] = ()
    post_processing: Sequence[tuple[str, dict]] = ()
    parameters: dict = field(default_factory=dict)

    def merged(self, extra: dict) -> "Request":
        """Dashboard settings: filters are appended, the other fields override."""
        changes = {k: v for k, v in extra.items() if k != "filters" and v is not None}
        filters = (*self.filters, *extra.get("filters", ()))
        return replace(self, filters=filters, **changes)


TIME_LABEL = "__timestamp"


class Dataset:
    """A table, view or read-only SELECT with calculated columns and saved metrics."""

    def __init__(
        self,
        df: DataFrame,
        calculated: dict[str, str] | None = None,
        metrics: dict[str, str] | None = None,
        time_column: str | None = None,
        rules: Sequence[Rule] = (),
        roles: Sequence[str] = (),
    ):
        self.metrics = dict(metrics or {})
        self.calculated = dict(calculated or {})
        self.time_column = time_column
        for clause in security_clauses(rules, roles):
            df = df.filter(F.expr(clause))
        self.df = df.select("*", *[F.expr(e).alias(n) for n, e in self.calculated.items()])

    @classmethod
    def from_sql(cls, spark: SparkSession, text: str, args: dict | None = None, **options) -> "Dataset":
        """A virtual dataset: exactly one read-only statement."""
        return cls(read_only_sql(spark, text, args), **options)

    @property
    def columns(self) -> list[str]:
        return self.df.columns

    def dtype(self, name: str) -> T.DataType:
        return self.df.schema[name].dataType

    def dimension(self, dim: str | Dim, request: Request) -> Column:
        if isinstance(dim, str):
            if dim == TIME_LABEL:
                axis = request.time_column or self.time_column
                if not axis:
                    raise RequestError("the request has no time column")
                return bucket(F.col(f"`{axis}`"), request.grain).alias(TIME_LABEL)
            if dim not in self.columns:
                raise RequestError(f"column missing in dataset: {dim}")
            return F.col(f"`{dim}`")
        if dim.expr is None and dim.label not in self.columns:
            raise RequestError(f"column missing in dataset: {dim.label}")
        source = F.expr(dim.expr) if dim.expr else F.col(f"`{dim.label}`")
        return bucket(source, dim.grain).alias(dim.label)

    def metric(self, metric: str | Metric) -> Column:
        if isinstance(metric, str):
            if metric not in self.metrics:
                raise RequestError(f"unknown metric: {metric}")
            return sql_aggregate(self.metrics[metric]).alias(metric)
        if metric.expr is not None:
            return sql_aggregate(metric.expr).alias(metric.label)
        aggregate = (metric.aggregate or "").upper()
        source = F.lit(1) if metric.column in (None, "*") else F.col(f"`{metric.column}`")
        if metric.column not in (None, "*") and metric.column not in self.columns:
            raise RequestError(f"column missing in dataset: {metric.column}")
        known = {
            "AVG": F.avg,
            "COUNT": F.count,
            "COUNT_DISTINCT": F.count_distinct,
            "APPROX_COUNT_DISTINCT": F.approx_count_distinct,
            "MAX": F.max,
            "MIN": F.min,
            "SUM": F.sum,
        }
        if aggregate not in known:
            raise RequestError(f"unknown aggregate: {metric.aggregate}")
        return known[aggregate](source).alias(metric.label)


def label_of(item: str | Dim | Metric) -> str:
    return item if isinstance(item, str) else item.label


def sql_aggregate(text: str) -> Column:
    """A free SQL aggregate; subqueries are refused."""
    # Comments and quoted texts are taken out first, so that neither hides nor feigns one.
    bare = re.sub(r"/\*.*?\*/|--[^\n]*|'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`", " ", text, flags=re.DOTALL)
    if re.search(r"\(\s*(?:select|with|from|table|values)\b", bare, re.IGNORECASE):
        raise RequestError("a metric may not hold a subquery")
    return F.expr(text)


def read_only_sql(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """One SELECT as a subquery; commands, DML and several statements do not parse there."""
    body = text.strip().rstrip(";")
    if _closes_early(body):
        raise RequestError("only a single read-only SELECT is allowed")
    try:
        return spark.sql(f"SELECT * FROM (\n{body}\n)", args=args or {})
    except ParseException as error:
        raise RequestError("only a single read-only SELECT is allowed") from error


def _closes_early(text: str) -> bool:
    """Whether a bracket closes that the text itself has not opened."""
    bare = re.sub(r"/\*.*?\*/|--[^\n]*|'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`", " ", text, flags=re.DOTALL)
    depth = 0
    for c in bare:
        depth += (c == "(") - (c == ")")
        if depth < 0:
            return True
    return depth != 0


def security_clauses(rules: Sequence[Rule], roles: Sequence[str]) -> list[str]:
    """Clauses that apply: OR inside a group, AND across groups."""
    held = set(roles)
    applied = [
        r
        for r in rules
        if (r.kind == "regular" and r.roles & held) or (r.kind == "base" and not r.roles & held)
    ]
    groups: dict[str, list[str]] = {}
    for i, rule in enumerate(applied):
        groups.setdefault(rule.group or f"__{i}", []).append(f"({rule.clause})")
    return ["(" + " OR ".join(clauses) + ")" for clauses in groups.values()]


def page_size(wanted: int | None) -> int:
    """Rows of a page: as many as asked for, else ``SAMPLES_LIMIT``."""
    if wanted is not None and wanted < 1:
        raise RequestError("a page needs at least one row")
    return wanted or SAMPLES_LIMIT
