"""Small golden inputs."""

from __future__ import annotations

import datetime as dt


def day(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def shops(spark):
    """Sales of some shops, one without an area, one without sales."""
    sales = {"north": (10, 12, 14, 16, 18), "south": (3, None, 5), "west": (7,), None: (8, 9)}
    rows = [(f"{area}-{k}", area, n) for area, numbers in sales.items() for k, n in enumerate(numbers)]
    return spark.createDataFrame(rows, "shop string, area string, sales long")


def stock(spark):
    """40 items on 5 shelves in 3 groups; every eighth has a stock count."""
    rows = [("all", f"g{i % 3}", f"s{i % 5}", f"item{i}", 2 * i, 80 - 2 * i, i if i % 8 == 0 else None) for i in range(40)]
    return spark.createDataFrame(rows, "whole string, kind string, shelf string, item string, up long, down long, sparse long")


def timeseries(spark, y=(4.0, 1.0, 6.0, 2.0), z=None):
    """Four days with gaps of one, two and four days between them."""
    start = day("2021-03-01")
    rows = [(start + dt.timedelta(days=2**i - 1), "klmn"[i], v, *((z[i],) if z else ())) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, label string, y double" + (", z double" if z else ""))


FRUIT = "apple fig plum pear kiwi lime date quince melon grape lemon peach".split()


def crates(spark):
    """A crate of each fruit, packed every second day and sold every fifth."""
    packed, sold = day("2021-03-01"), day("2021-06-01")
    rows = [(i, name, 0.5 * i, None, packed + dt.timedelta(days=2 * i), sold + dt.timedelta(days=5 * i)) for i, name in enumerate(FRUIT)]
    return spark.createDataFrame(rows, "crate int, fruit string, weight double, note string, packed timestamp_ntz, sold timestamp_ntz")


def texts(spark):
    """Words that are easily taken for something else."""
    values = ["tea", "", None, "null", '"in quotes"', "it's", 'half " way', "it''s"]
    return spark.createDataFrame([(v,) for v in values], "word string")


def visits(spark):
    counts = {"NO": (2, 3), "PE": (7, 1)}
    rows = [(day("2021-03-01") + dt.timedelta(days=d), land, n) for land, numbers in counts.items() for d, n in enumerate(numbers)]
    return spark.createDataFrame(rows, "day timestamp_ntz, land string, visits long")


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*order).collect()]
