"""Compare a Spark result with the DuckDB result of the twin SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    """A comparable form; kinds stay apart (an integer never equals a float)."""
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        if math.isnan(value):
            return ("nan",)
        return ("float", round(value, 9) + 0.0)
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)) and not hasattr(value, "asDict"):
        return ("list", tuple(plain(v) for v in value))
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return ("map", tuple(sorted((k, plain(v)) for k, v in value.items())))
    return (type(value).__name__, value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    sql_rows = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(spark_rows) != len(sql_rows):
        return f"row counts {len(spark_rows)} != {len(sql_rows)}\n  {spark_rows[:2]}\n  {sql_rows[:2]}"
    for a, b in zip(spark_rows, sql_rows):
        if a != b:
            return f"columns {sorted(names)}\n  spark {a}\n  sql   {b}"
    return None
