"""Every registered query on the smallest tables, against its SQL twin where it has one."""

from __future__ import annotations

import pytest
from places import FOLDER
from oracle import connect, difference

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert difference(df, duck, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "month"


def test_twins_belong_to_queries():
    assert set(SQL) <= set(QUERIES)
