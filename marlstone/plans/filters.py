"""Filters of a request as plain column predicates (so they reach the scan)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import network, timerange
from .request import Dataset, Filter, RequestError

# Texts that stand for null and the empty string.
NULL_TEXT = "<NULL>"
EMPTY_TEXT = "<empty string>"

TRUE_TEXTS = ("true", "1", "t", "yes")

# Beyond this many values a list becomes a table and the filter a semi join.
LIST_AS_TABLE = 2_000


def literal(value: object, dtype: T.DataType) -> Column:
    """``value`` as a literal of the column's type, so the column itself stays bare."""
    if isinstance(value, datetime):
        text = value.isoformat(sep=" ")
        if isinstance(dtype, T.StringType):
            return F.lit(text)
        return F.lit(text).cast(dtype)
    if isinstance(dtype, T.BooleanType) and isinstance(value, str):
        return F.lit(value.strip().lower() in TRUE_TEXTS)
    return F.lit(value).cast(dtype)


def _meaning(value: object) -> object:
    if value == NULL_TEXT:
        return None
    if value == EMPTY_TEXT:
        return ""
    return value


def _values(value: object) -> list[object]:
    if isinstance(value, (list, tuple, set, frozenset)):
        return [_meaning(v) for v in value]
    return [_meaning(value)]


def predicate(dataset: Dataset, item: Filter, now: datetime) -> Column:
    column, op = F.col(f"`{item.column}`"), item.op.upper().strip()
    dtype = dataset.dtype(item.column)
    if item.advanced == "address":
        number = network.address_number(column) if isinstance(dtype, T.StringType) else column
        return network.address_filter(number, op, [str(v) for v in _values(item.value)])
    if item.advanced == "port":
        return network.port_filter(column, op, _values(item.value))
    if op in ("IN", "NOT IN"):
        values = _values(item.value)
        if not values:
            raise RequestError("the list of a filter is empty")
        present = [literal(v, dtype) for v in values if v is not None]
        has_null = any(v is None for v in values)
        if op == "IN":
            test = column.isin(*present) if present else F.lit(False)
            return (test | column.isNull()) if has_null else test
        test = ~column.isin(*present) if present else F.lit(True)
        return (test & column.isNotNull()) if has_null else test
    if op == "IS NULL":
        return column.isNull()
    if op == "IS NOT NULL":
        return column.isNotNull()
    if op == "IS TRUE":
        return column.cast("boolean") == F.lit(True)
    if op == "IS FALSE":
        return column.cast("boolean") == F.lit(False)
    if op == "TEMPORAL_RANGE":
        since, until = timerange.resolve(str(item.value), now)
        return between(column, dtype, since, until)
    value = _meaning(item.value)
    if value is None:
        if op == "==":
            return column.isNull()
        if op == "!=":
            return column.isNotNull()
        raise RequestError(f"operator {op} needs a value")
    if op in ("LIKE", "ILIKE", "NOT LIKE", "NOT ILIKE"):
        text = column.cast("string")
        test = text.ilike(str(value)) if op.endswith("ILIKE") else text.like(str(value))
        return ~test if op.startswith("NOT") else test
    if op == "REGEX":
        return column.cast("string").rlike(str(value))
    other = literal(value, dtype)
    simple = {
        "==": column == other,
        "!=": column != other,
        ">": column > other,
        "<": column < other,
        ">=": column >= other,
        "<=": column <= other,
    }
    if op not in simple:
        raise RequestError(f"unknown filter operator: {item.op}")
    return simple[op]


def between(column: Column, dtype: T.DataType, since: datetime | None, until: datetime | None) -> Column:
    """Half-open range test."""
    test = F.lit(True)
    if since is not None:
        test = column >= literal(since, dtype)
    if until is not None:
        upper = column < literal(until, dtype)
        test = upper if since is None else test & upper
    return test


def split_known(dataset: Dataset, filters: Sequence[Filter]) -> tuple[list[Filter], list[Filter]]:
    """Filters that apply, and those whose column the dataset lacks."""
    applied = [f for f in filters if f.column in dataset.columns]
    rejected = [f for f in filters if f.column not in dataset.columns]
    return applied, rejected


def apply_filters(dataset: Dataset, df: DataFrame, filters: Sequence[Filter], now: datetime) -> DataFrame:
    applied, _ = split_known(dataset, filters)
    for item in applied:
        op = item.op.upper().strip()
        if op in ("IN", "NOT IN") and item.advanced is None:
            values = _values(item.value)
            if len(values) > LIST_AS_TABLE:
                df = _filter_by_table(df, item.column, dataset.dtype(item.column), values, op)
                continue
        df = df.filter(predicate(dataset, item, now))
    return df


def _listed(df: DataFrame, dtype: T.DataType, values: list) -> DataFrame:
    """The values as a table; each kind of value is cast as its literal would be."""
    kinds: dict[type, list] = {}
    for v in values:
        if isinstance(dtype, T.BooleanType) and isinstance(v, str):
            v = v.strip().lower() in TRUE_TEXTS
        if isinstance(v, datetime):
            v = v.isoformat(sep=" ")
        kinds.setdefault(type(v), []).append((v,))
    schema = {bool: "boolean", int: "bigint", float: "double", str: "string"}
    out = df.sparkSession.createDataFrame([], T.StructType([T.StructField("__v", dtype)]))
    for kind, rows in kinds.items():
        table = df.sparkSession.createDataFrame(rows, f"v {schema[kind]}" if kind in schema else ["v"])
        out = out.unionByName(table.select(F.col("v").cast(dtype).alias("__v")))
    return out


def _filter_by_table(df: DataFrame, name: str, dtype: T.DataType, values: list, op: str) -> DataFrame:
    listed = _listed(df, dtype, [v for v in values if v is not None])
    column = F.col(f"`{name}`")
    has_null = any(v is None for v in values)
    if op == "IN":
        listed = listed.filter(F.col("__v").isNotNull())
        if has_null:
            listed = listed.unionByName(df.sparkSession.range(1).select(F.lit(None).cast(dtype).alias("__v")))
        return df.join(listed.distinct(), column.eqNullSafe(F.col("__v")), "left_semi")
    kept = df.filter(column.isNotNull())
    return kept.join(listed.distinct(), column == F.col("__v"), "left_anti")
