"""Free SQL sees the rows of its reader's roles, and no other relations."""

from __future__ import annotations

import pytest

from marlstone.plans.free_sql import run_free_sql
from marlstone.plans.request import Dataset, RequestError, Rule


@pytest.fixture(scope="module")
def datasets(spark):
    sales = spark.createDataFrame([(i, i % 4, 10.0 * i) for i in range(40)], "id int, area int, price double")
    areas = spark.createDataFrame([(i, f"area {i}") for i in range(4)], "area int, name string")
    spark.createDataFrame([(1, "hidden")], "id int, secret string").createOrReplaceTempView("private_rows")
    rules = [Rule("area < 2", frozenset({"south"}))]
    return {"sales": Dataset(sales, rules=rules, roles=["south"]), "Areas": Dataset(areas, rules=[Rule("area <> 1", frozenset({"south"}))], roles=["south"])}


@pytest.mark.parametrize(
    "text,want",
    [
        ("SELECT count(*) FROM sales", 20),
        ("select count(*) from SALES s", 20),
        ("SELECT count(*) FROM `sales` AS areas_of;", 20),
        ("-- all of it\n/* and\n more */ SELECT count(*) FROM sales", 20),
        ("SELECT count(*) FROM sales a JOIN sales b ON a.area = b.area", 200),
        ("SELECT count(*) FROM sales JOIN areas USING (area)", 10),
        ("SELECT (SELECT max(id) FROM sales) + count(*) FROM areas", 40),
        ("SELECT count(*) FROM areas WHERE area IN (SELECT area FROM sales)", 1),
        ("SELECT count(*) FROM sales s WHERE EXISTS (SELECT 1 FROM areas a WHERE a.area = s.area)", 10),
        ("WITH x AS (SELECT * FROM sales), y AS (SELECT * FROM x) SELECT count(*) FROM y", 20),
        ("WITH x AS (WITH z AS (SELECT * FROM sales) SELECT * FROM z) SELECT count(*) FROM x", 20),
        ("WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 5) SELECT sum(n) + (SELECT count(*) FROM sales) FROM r", 35),
        ("SELECT count(*) FROM (SELECT id FROM sales UNION ALL SELECT area FROM areas)", 23),
        ("SELECT count(*) FROM sales, LATERAL (SELECT name FROM areas WHERE areas.area = sales.area)", 10),
        ("SELECT count(*) FROM range(7)", 7),
        ("SELECT count(*) FROM sales WHERE '{x}' = concat('{', 'x}')", 20),
        ("(SELECT count(*) FROM sales)", 20),
    ],
)
def test_rows_of_the_roles(spark, datasets, text, want):
    assert run_free_sql(spark, text, datasets).first()[0] == want


def test_order_is_kept(spark, datasets):
    rows = run_free_sql(spark, "WITH x AS (SELECT id FROM sales) SELECT id FROM x ORDER BY id DESC LIMIT 3", datasets).collect()
    assert [r[0] for r in rows] == [37, 36, 33]


@pytest.mark.parametrize(
    "text",
    [
        "SELECT * FROM private_rows",
        "SELECT * FROM sales JOIN private_rows USING (id)",
        "SELECT (SELECT max(secret) FROM private_rows) FROM sales",
        "WITH a AS (SELECT * FROM private_rows) SELECT * FROM a",
        "SELECT * FROM spark_catalog.default.sales",
        "SELECT * FROM parquet.`/tmp/anything`",
        "SELECT * FROM IDENTIFIER('private' || '_rows')",
        "SELECT * FROM (WITH private_rows AS (SELECT 1 AS id) SELECT id FROM private_rows) UNION ALL SELECT id FROM private_rows",
        "SELECT 'CTE [private_rows]', secret FROM private_rows",
        "SELECT '\n== Analyzed Logical Plan ==', secret FROM private_rows",
        "WITH sales AS (SELECT 1 AS id) SELECT * FROM sales",
        "TABLE private_rows",
        "DROP VIEW private_rows",
        "SHOW TABLES",
        "INSERT INTO sales VALUES (1, 2, 3)",
        "SELECT 1; DROP VIEW private_rows",
        "SELECT 1) x JOIN (SELECT * FROM private_rows",
        "SELECT TRANSFORM(id) USING 'cat' AS (x STRING) FROM sales",
        "EXPLAIN SELECT * FROM private_rows",
    ],
)
def test_what_is_refused(spark, datasets, text):
    with pytest.raises(RequestError):
        run_free_sql(spark, text, datasets)
    assert spark.catalog.tableExists("private_rows")


def test_rules_of_other_roles(spark, datasets):
    free = Dataset(datasets["sales"].df.sparkSession.createDataFrame([(i,) for i in range(9)], "id int"), rules=[Rule("id < 3", frozenset({"admin"}), kind="base")], roles=["admin"])
    assert run_free_sql(spark, "SELECT count(*) FROM s", {"s": free}).first()[0] == 9
