"""Time grains: ISO duration names to bucket expressions.

Results are wall-clock timestamps (``timestamp_ntz``), so a bucket of an NTZ
column does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grain names.
UNIT_GRAINS = {
    "PT1S": "second",
    "PT1M": "minute",
    "PT1H": "hour",
    "P1D": "day",
    "P1W": "week",
    "1969-12-29T00:00:00Z/P1W": "week",
    "P1M": "month",
    "P3M": "quarter",
    "P0.25Y": "quarter",
    "P1Y": "year",
}
STEP_GRAINS = {
    "PT5S": 5,
    "PT30S": 30,
    "PT5M": 300,
    "PT10M": 600,
    "PT15M": 900,
    "PT30M": 1800,
    "PT0.5H": 1800,
    "PT6H": 21600,
}
WEEK_STARTING_SUNDAY = "1969-12-28T00:00:00Z/P1W"
WEEK_ENDING_SATURDAY = "P1W/1970-01-03T00:00:00Z"
WEEK_ENDING_SUNDAY = "P1W/1970-01-04T00:00:00Z"
WEEK_VARIANTS = (WEEK_STARTING_SUNDAY, WEEK_ENDING_SATURDAY, WEEK_ENDING_SUNDAY)

ALL_GRAINS = (*UNIT_GRAINS, *STEP_GRAINS, *WEEK_VARIANTS)

# Step between neighbouring buckets, as SQL interval text.
GRAIN_STEP = {
    "PT1S": "1 second",
    "PT5S": "5 seconds",
    "PT30S": "30 seconds",
    "PT1M": "1 minute",
    "PT5M": "5 minutes",
    "PT10M": "10 minutes",
    "PT15M": "15 minutes",
    "PT30M": "30 minutes",
    "PT0.5H": "30 minutes",
    "PT1H": "1 hour",
    "PT6H": "6 hours",
    "P1D": "1 day",
    "P1W": "7 days",
    WEEK_STARTING_SUNDAY: "7 days",
    "1969-12-29T00:00:00Z/P1W": "7 days",
    WEEK_ENDING_SATURDAY: "7 days",
    WEEK_ENDING_SUNDAY: "7 days",
    "P1M": "1 month",
    "P3M": "3 months",
    "P0.25Y": "3 months",
    "P1Y": "1 year",
}


def wall(column: Column) -> Column:
    return column.cast("timestamp_ntz")


def shift(column: Column, interval: str) -> Column:
    """``column`` moved by an interval text such as ``-1 day``."""
    amount, unit = interval.split()
    return F.timestamp_add(unit.rstrip("s").upper(), F.lit(int(amount)), wall(column))


def bucket(column: Column, grain: str | None) -> Column:
    """Start (or, for the week-ending grains, end day) of the bucket of ``column``."""
    if not grain:
        return column
    if grain in UNIT_GRAINS:
        return wall(F.date_trunc(UNIT_GRAINS[grain], column))
    if grain in STEP_GRAINS:
        of_day = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        past = of_day % STEP_GRAINS[grain]
        return F.timestamp_add("SECOND", -past, wall(F.date_trunc("second", column)))
    if grain == WEEK_STARTING_SUNDAY:
        return shift(F.date_trunc("week", shift(column, "1 day")), "-1 day")
    if grain == WEEK_ENDING_SATURDAY:
        return shift(F.date_trunc("week", shift(column, "1 day")), "5 days")
    if grain == WEEK_ENDING_SUNDAY:
        return shift(F.date_trunc("week", column), "6 days")
    raise ValueError(f"unknown time grain {grain}")


def week_number_sunday(column: Column) -> Column:
    """Week of the year, weeks starting on Sunday (00 before the first one)."""
    return F.floor((F.dayofyear(column) + 7 - F.dayofweek(column)) / 7).cast("int")


def week_number_monday(column: Column) -> Column:
    """Week of the year, weeks starting on Monday (00 before the first one)."""
    return F.floor((F.dayofyear(column) + 6 - F.weekday(column)) / 7).cast("int")


def offset_key(column: Column, grain: str, offset: Column | None = None) -> Column:
    """Text by which rows of two shifted time ranges are matched."""
    moved = wall(column) if offset is None else offset
    year = F.date_format(moved, "yyyy")
    if grain in ("P1W", "1969-12-29T00:00:00Z/P1W", WEEK_ENDING_SUNDAY):
        return F.concat(year, F.lit("-W"), F.lpad(week_number_monday(moved).cast("string"), 2, "0"))
    if grain in (WEEK_STARTING_SUNDAY, WEEK_ENDING_SATURDAY):
        return F.concat(year, F.lit("-W"), F.lpad(week_number_sunday(moved).cast("string"), 2, "0"))
    if grain == "P1M":
        return F.date_format(moved, "yyyy-MM")
    if grain in ("P3M", "P0.25Y"):
        return F.concat(year, F.lit("-Q"), F.quarter(moved).cast("string"))
    if grain == "P1Y":
        return year
    return F.date_format(moved, "yyyy-MM-dd HH:mm:ss.SSSSSS")
