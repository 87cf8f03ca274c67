"""Time grains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grains import (
    STEP_GRAINS,
    UNIT_GRAINS,
    WEEK_ENDING_SATURDAY,
    WEEK_ENDING_SUNDAY,
    WEEK_STARTING_SUNDAY,
    bucket,
)
from .registry import Tables, query


def by_grain(t: Tables, grains: dict[str, str]) -> DataFrame:
    """Events per bucket of every grain, from one scan."""
    ts = F.col("ts")
    buckets = F.array(
        *[F.struct(F.lit(name).alias("grain"), bucket(ts, grain).alias("bucket")) for name, grain in grains.items()]
    )
    spread = t("events").select(F.explode(buckets).alias("g"), "value")
    return spread.groupBy("g.grain", "g.bucket").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


def _sql(parts: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS grain, ({expr})::TIMESTAMP AS bucket, count(*)::BIGINT AS n, "
        f"round(sum(value), 4) AS total FROM events GROUP BY 2"
        for name, expr in parts.items()
    )


@query("grain_trunc", _sql({g: f"date_trunc('{u}', ts)" for g, u in UNIT_GRAINS.items()}))
def grain_trunc(t: Tables) -> DataFrame:
    return by_grain(t, {g: g for g in UNIT_GRAINS})


@query("grain_multiple", _sql({g: f"time_bucket(INTERVAL {s} SECOND, ts)" for g, s in STEP_GRAINS.items()}))
def grain_multiple(t: Tables) -> DataFrame:
    return by_grain(t, {g: g for g in STEP_GRAINS})


@query(
    "grain_week_variants",
    _sql(
        {
            "starting sunday": "date_trunc('week', ts + INTERVAL 1 DAY) - INTERVAL 1 DAY",
            "ending saturday": "date_trunc('week', ts + INTERVAL 1 DAY) + INTERVAL 5 DAY",
            "ending sunday": "date_trunc('week', ts) + INTERVAL 6 DAY",
        }
    ),
)
def grain_week_variants(t: Tables) -> DataFrame:
    return by_grain(
        t,
        {
            "starting sunday": WEEK_STARTING_SUNDAY,
            "ending saturday": WEEK_ENDING_SATURDAY,
            "ending sunday": WEEK_ENDING_SUNDAY,
        },
    )


@query("grain_none", "SELECT o_orderdate AS bucket, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def grain_none(t: Tables) -> DataFrame:
    return t("orders").groupBy(bucket(F.col("o_orderdate"), None).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
