"""Alert checks on query results, and their execution log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Operators of an alert threshold.
COMPARISONS = (">=", ">", "<=", "<", "==", "!=")


class AlertError(ValueError):
    """The alert query does not give a single value."""


def alert_value(df: DataFrame) -> float | None:
    """The one value of an alert query; two rows are enough to see a mistake."""
    if len(df.columns) > 1:
        raise AlertError("alert query returned more than one column")
    rows = df.limit(2).collect()
    if len(rows) > 1:
        raise AlertError("alert query returned more than one row")
    return rows[0][0] if rows else None


def compare(value: Column, operator: str, threshold: float) -> Column:
    other = F.lit(float(threshold))
    ways = {
        ">=": value >= other, ">": value > other, "<=": value <= other,
        "<": value < other, "==": value == other, "!=": value != other,
    }
    if operator not in ways:
        raise AlertError(f"unknown alert operator {operator}")
    return ways[operator]


def operator_alert(df: DataFrame, operator: str, threshold: float) -> bool:
    raw = alert_value(df)
    try:
        value = float(raw) if raw is not None else 0.0
    except (TypeError, ValueError) as error:
        raise AlertError("alert query returned a non-number value") from error
    if value != value:
        value = 0.0
    tests = {
        ">=": value >= threshold, ">": value > threshold, "<=": value <= threshold,
        "<": value < threshold, "==": value == threshold, "!=": value != threshold,
    }
    if operator not in tests:
        raise AlertError(f"unknown alert operator {operator}")
    return tests[operator]


def not_null_alert(df: DataFrame) -> bool:
    value = alert_value(df)
    return value is not None and value != 0 and value == value


def run_rules(df: DataFrame, rules: dict[str, tuple[Column, str, float]]) -> DataFrame:
    """Many rules over one table in one scan: value and state per rule."""
    sums = df.agg(*[F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"__r{i}") for i, (c, _, _) in enumerate(rules.values())])
    items = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"__r{i}").alias("value"),
            compare(F.col(f"__r{i}"), operator, threshold).alias("triggered"),
        )
        for i, (name, (_, operator, threshold)) in enumerate(rules.items())
    ]
    return sums.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def append_log(results: DataFrame, path: str, at: Column) -> None:
    """Append the states of one execution."""
    state = F.when(F.col("triggered"), F.lit("Triggered")).otherwise(F.lit("Not triggered"))
    results.select("rule", "value", state.alias("state"), at.alias("run_at")).write.mode("append").parquet(path)


def log_states(log: DataFrame, keys: Sequence[str], at: str, state: str, grace_seconds: int) -> DataFrame:
    """Executions with the previous state, and whether they fall into the grace period.

    One row per rule and execution, so a rule's window is bounded by its schedule.
    """
    window = Window.partitionBy(*keys).orderBy(at)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    last_success = F.max(F.when(F.col(state) == "Triggered", F.col(at))).over(earlier)
    waited = F.timestamp_diff("SECOND", last_success, F.col(at))
    return log.select(
        *keys, at, state,
        F.lag(state).over(window).alias("previous_state"),
        F.coalesce(waited < grace_seconds, F.lit(False)).alias("in_grace"),
    )
