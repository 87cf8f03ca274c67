"""SQL texts with named values taken from the active filters.

Values travel as named parameters of ``spark.sql`` and datasets as DataFrames,
so nothing is spliced into the text.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .builder import bounds
from .filters import _values
from .request import Request, RequestError


def filter_values(request: Request, column: str, default: object = None) -> list[object]:
    """Values of the equality and list filters on ``column``."""
    found: list[object] = []
    for item in request.filters:
        if item.column == column and item.op.upper() in ("IN", "=="):
            found += _values(item.value)
    if not found and default is not None:
        found = [default]
    return found


def array_test(column: str, name: str) -> str:
    """Text of a membership test against a list parameter."""
    if not (column.isidentifier() and name.isidentifier()):
        raise RequestError("a membership test takes plain names")
    return f"array_contains(:{name}, {column})"


def parameter(value: object) -> object:
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value])
    if isinstance(value, datetime):
        # text takes the type of the column it is compared with, so the column stays bare
        return value.isoformat(sep=" ")
    return value


def run_template(
    spark: SparkSession,
    text: str,
    request: Request,
    now: datetime,
    lists: dict[str, str] | None = None,
    datasets: dict[str, DataFrame] | None = None,
    values: dict[str, object] | None = None,
) -> DataFrame:
    """Run ``text`` with ``:from_dttm``, ``:to_dttm``, the filter lists and further values.

    ``{name}`` stands for a dataset, which may itself be a filtered view.
    """
    since, until = bounds(request, now)
    given: dict[str, object] = {**request.parameters, **(values or {})}
    given.update(from_dttm=since, to_dttm=until)
    for name, column in (lists or {}).items():
        given[name] = filter_values(request, column)
    args: dict[str, object | Column] = {
        k: parameter(v) for k, v in given.items() if v is not None and f":{k}" in text
    }
    return spark.sql(text, args=args, **(datasets or {}))
