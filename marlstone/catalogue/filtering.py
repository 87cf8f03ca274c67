"""Filters and time ranges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import network
from ..functions.grains import shift
from ..operators.addresses import longest_blocks
from ..plans import builder
from ..plans.request import Dataset, Filter, Metric, Request
from .registry import Tables, query

NOW = datetime(2001, 6, 15, 9, 30)
COUNT = Metric("n", "COUNT", "*")


def counted(df: DataFrame, columns: list, *filters: Filter, **options) -> DataFrame:
    request = Request(columns=columns, metrics=[COUNT], filters=filters, **options)
    return builder.compile_request(Dataset(df), request, NOW)


@query(
    "filter_compare",
    """
    SELECT l_returnflag, count(*)::BIGINT AS n FROM lineitem
    WHERE l_quantity >= 10 AND l_quantity < 40 AND l_discount <= 0.08 AND l_tax > 0.01
      AND l_linestatus = 'O' AND l_linenumber <> 7 GROUP BY 1
    """,
)
def filter_compare(t: Tables) -> DataFrame:
    return counted(
        t("lineitem"),
        ["l_returnflag"],
        Filter("l_quantity", ">=", "10"),
        Filter("l_quantity", "<", 40),
        Filter("l_discount", "<=", 0.08),
        Filter("l_tax", ">", 0.01),
        Filter("l_linestatus", "==", "O"),
        Filter("l_linenumber", "!=", "7"),
    )


@query(
    "filter_in",
    """
    SELECT o_orderstatus, count(*)::BIGINT AS n FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_custkey NOT IN (1, 2, 3, 5, 8, 13) GROUP BY 1
    """,
)
def filter_in(t: Tables) -> DataFrame:
    return counted(
        t("orders"),
        ["o_orderstatus"],
        Filter("o_orderpriority", "IN", ["1-URGENT", "5-LOW"]),
        Filter("o_custkey", "NOT IN", ["1", "2", "3", "5", "8", "13"]),
    )


@query(
    "filter_in_sentinels",
    """
    WITH e AS (SELECT CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN '' ELSE event_type END AS kind FROM events)
    SELECT 'null or empty' AS test, count(*)::BIGINT AS n FROM e WHERE kind IS NULL OR kind = ''
    UNION ALL SELECT 'not null, not signup', count(*) FROM e WHERE kind IS NOT NULL AND kind <> 'signup'
    """,
)
def filter_in_sentinels(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", F.lit("")).when(F.col("event_type") != "view", F.col("event_type"))
    events = t("events").select(kind.alias("kind"))
    first = counted(events, [], Filter("kind", "IN", ["<NULL>", "<empty string>"]))
    second = counted(events, [], Filter("kind", "NOT IN", [None, "signup"]))
    return first.select(F.lit("null or empty").alias("test"), "n").unionByName(
        second.select(F.lit("not null, not signup").alias("test"), "n")
    )


@query(
    "filter_in_long_list",
    """
    SELECT l_returnflag, count(*)::BIGINT AS n FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY 1
    """,
)
def filter_in_long_list(t: Tables) -> DataFrame:
    """A list as a request may hold it, here the urgent orders, becomes a table and the filter a semi join."""
    urgent = t("orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return counted(t("lineitem"), ["l_returnflag"], Filter("l_orderkey", "IN", [r[0] for r in urgent.collect()]))


@query(
    "filter_like",
    """
    SELECT p_brand, count(*)::BIGINT AS n FROM part
    WHERE p_name LIKE '%ring%' OR p_name ILIKE 'RED%' OR regexp_matches(p_name, '^(blue|small) [a-w]+$') GROUP BY 1
    """,
)
def filter_like(t: Tables) -> DataFrame:
    data = Dataset(t("part"))
    tests = [Filter("p_name", "LIKE", "%ring%"), Filter("p_name", "ILIKE", "RED%"), Filter("p_name", "REGEX", "^(blue|small) [a-w]+$")]
    from ..plans.filters import predicate

    either = predicate(data, tests[0], NOW) | predicate(data, tests[1], NOW) | predicate(data, tests[2], NOW)
    return data.df.filter(either).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filter_null_bool",
    """
    WITH e AS (SELECT CASE WHEN event_type = 'view' THEN NULL ELSE value > 50 END AS big FROM events)
    SELECT 'null' AS test, count(*)::BIGINT AS n FROM e WHERE big IS NULL
    UNION ALL SELECT 'not null', count(*) FROM e WHERE big IS NOT NULL
    UNION ALL SELECT 'true', count(*) FROM e WHERE big
    UNION ALL SELECT 'false', count(*) FROM e WHERE NOT big
    """,
)
def filter_null_bool(t: Tables) -> DataFrame:
    big = F.when(F.col("event_type") != "view", F.col("value") > 50)
    data = Dataset(t("events").select(big.alias("big")))
    from ..plans.filters import predicate

    tests = {"null": "IS NULL", "not null": "IS NOT NULL", "true": "IS TRUE", "false": "IS FALSE"}
    # four counts from one scan
    counts = data.df.agg(*[F.count_if(predicate(data, Filter("big", op), NOW)).alias(name) for name, op in tests.items()])
    return counts.unpivot([], [F.col(f"`{n}`") for n in tests], "test", "n")


@query(
    "filter_temporal_range",
    """
    SELECT l_linestatus, count(*)::BIGINT AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate >= TIMESTAMP '1996-02-01' AND l_shipdate < TIMESTAMP '1999-02-01'
      AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1
    """,
)
def filter_temporal_range(t: Tables) -> DataFrame:
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return counted(
        joined,
        ["l_linestatus"],
        Filter("l_shipdate", "TEMPORAL_RANGE", "1996-02-01 : 1999-02-01"),
        Filter("o_orderdate", "TEMPORAL_RANGE", "1996-01-01 : 1999-01-01"),
    )


@query(
    "time_range_expr",
    """
    SELECT 'Last quarter' AS text, count(*)::BIGINT AS n FROM orders
      WHERE o_orderdate >= TIMESTAMP '2001-03-15' AND o_orderdate < TIMESTAMP '2001-06-15'
    UNION ALL SELECT 'previous calendar year', count(*) FROM orders
      WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'
    UNION ALL SELECT '3 years ago : 1 year ago', count(*) FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-06-15' AND o_orderdate < TIMESTAMP '2000-06-15'
    UNION ALL SELECT 'DATETRUNC(DATEADD(DATETIME(''today''), -2, YEAR), YEAR) : LASTDAY(DATETIME(''today''), MONTH)', count(*)
      FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2001-06-30'
    UNION ALL SELECT 'No filter', count(*) FROM orders
    """,
)
def time_range_expr(t: Tables) -> DataFrame:
    texts = [
        "Last quarter",
        "previous calendar year",
        "3 years ago : 1 year ago",
        "DATETRUNC(DATEADD(DATETIME('today'), -2, YEAR), YEAR) : LASTDAY(DATETIME('today'), MONTH)",
        "No filter",
    ]
    data = Dataset(t("orders"))
    from ..plans.filters import predicate

    tests = [predicate(data, Filter("o_orderdate", "TEMPORAL_RANGE", text), NOW) for text in texts]
    counts = data.df.agg(*[F.count_if(test).alias(text) for text, test in zip(texts, tests)])
    return counts.unpivot([], [F.col(f"`{x}`") for x in texts], "text", "n")


@query(
    "time_range_per_row",
    """
    SELECT o_orderkey, o_orderdate - INTERVAL 1 MONTH AS month_before,
           date_trunc('month', o_orderdate)::TIMESTAMP AS month_start,
           last_day(o_orderdate)::TIMESTAMP AS month_end
    FROM orders
    """,
)
def time_range_per_row(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t("orders").select(
        "o_orderkey",
        shift(d, "-1 month").alias("month_before"),
        F.date_trunc("month", d).cast("timestamp_ntz").alias("month_start"),
        F.last_day(d).cast("timestamp_ntz").alias("month_end"),
    )


ADDRESS_SQL = """
    WITH a AS (SELECT event_id, event_type,
                      3232235520 + (user_id % 4) * 256 + event_id % 256 AS addr FROM events)
"""


def _addresses(t: Tables) -> DataFrame:
    """Client address per event, as dotted text and as number."""
    number = F.lit(3232235520) + (F.col("user_id") % 4) * 256 + F.col("event_id") % 256
    dotted = F.concat_ws(
        ".", *[F.shiftright(F.col("addr"), s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    )
    return t("events").select("event_id", "event_type", number.cast("long").alias("addr")).withColumn("client", dotted)


@query(
    "filter_ip_cidr",
    ADDRESS_SQL
    + """
    SELECT 'in block' AS test, count(*)::BIGINT AS n FROM a WHERE addr BETWEEN 3232235776 AND 3232236031
    UNION ALL SELECT 'not in', count(*) FROM a
      WHERE NOT (addr BETWEEN 3232235776 AND 3232236031 OR addr = 3232235530)
    UNION ALL SELECT 'above block', count(*) FROM a WHERE addr > 3232236031
    UNION ALL SELECT 'text equals', count(*) FROM a WHERE addr = 3232235530
    """,
)
def filter_ip_cidr(t: Tables) -> DataFrame:
    number, text = F.col("addr"), network.address_number(F.col("client"))
    tests = {
        "in block": network.address_filter(number, "==", ["192.168.1.0/24"]),
        "not in": network.address_filter(number, "NOT IN", ["192.168.1.0/24", "192.168.0.10"]),
        "above block": network.address_filter(number, ">", ["192.168.1.0/24"]),
        "text equals": network.address_filter(text, "==", ["192.168.0.10"]),
    }
    counts = _addresses(t).agg(*[F.count_if(c).alias(n) for n, c in tests.items()])
    return counts.unpivot([], [F.col(f"`{n}`") for n in tests], "test", "n")


@query(
    "filter_port",
    """
    WITH p AS (SELECT event_type, 1 + (event_id * 7) % 1100 AS port FROM events)
    SELECT 'ftp' AS test, count(*)::BIGINT AS n FROM p WHERE port IN (20, 21)
    UNION ALL SELECT 'not web', count(*) FROM p WHERE port NOT IN (80, 443)
    UNION ALL SELECT 'above ftps', count(*) FROM p WHERE port > 989
    """,
)
def filter_port(t: Tables) -> DataFrame:
    port = 1 + (F.col("event_id") * 7) % 1100
    tests = {
        "ftp": network.port_filter(port, "==", ["ftp"]),
        "not web": network.port_filter(port, "NOT IN", ["http", "443"]),
        "above ftps": network.port_filter(port, ">", ["ftps"]),
    }
    counts = t("events").agg(*[F.count_if(c).alias(n) for n, c in tests.items()])
    return counts.unpivot([], [F.col(f"`{n}`") for n in tests], "test", "n")


def _mixed_addresses(t: Tables) -> DataFrame:
    """An address per event: IPv4, for every third IPv6, now and then none."""
    user, event = F.col("user_id"), F.col("event_id")
    four = F.concat_ws(".", F.lit("10"), *[x.cast("string") for x in (user % 64, event % 32, F.floor(event / 32) % 256)])
    six = F.concat(F.lit("2001:db8:"), F.lower(F.hex(user % 64)), F.lit("::"), F.lower(F.hex(event % 4096)))
    text = F.when(event % 101 == 0, F.lit("n/a")).when(event % 3 == 0, six).otherwise(four)
    return t("events").select("event_id", text.alias("client"))


def _block_table(t: Tables) -> DataFrame:
    """Blocks of all sizes: regions hold nations, these customers and suppliers; parts are single hosts."""
    hexed = lambda c: F.lower(F.hex(F.col(c).cast("long")))
    text = lambda c, m=256: (F.col(c) % m).cast("string")
    dotted = lambda *p: F.concat(F.concat_ws(".", F.lit("10"), *p[:-1]), F.lit(p[-1]))
    zero = F.lit("0")
    return (
        t("region").where("r_regionkey < 2").select(dotted(F.col("r_regionkey") * 16, zero, zero, "/12").alias("block"), F.col("r_name").alias("owner"))
        .union(t("region").where("r_regionkey = 4").select(F.lit("2001:db8::/32"), "r_name"))
        .union(t("nation").select(dotted(text("n_nationkey"), zero, zero, "/16"), "n_name"))
        .union(t("nation").select(F.concat(F.lit("2001:db8:"), hexed("n_nationkey"), F.lit("::/48")), "n_name"))
        .union(t("customer").where("c_custkey % 2 = 0").select(dotted(text("c_custkey", 64), text("c_nationkey"), zero, "/24"), F.concat(F.lit("customer "), text("c_custkey", 64), F.lit(" "), text("c_nationkey"))).distinct())
        .union(t("supplier").select(F.concat(F.lit("2001:DB8:"), hexed("s_nationkey"), F.lit(":0:0:0:0:"), F.lower(F.hex(F.col("s_suppkey").cast("long") % 4096)), F.lit("/124")), F.concat(F.lit("supplier "), hexed("s_nationkey"), F.lit(" "), F.floor(F.col("s_suppkey") % 4096 / 16).cast("string"))))
        .union(t("part").select(dotted(text("p_partkey", 64), text("p_partkey", 32), text("p_partkey", 251), ""), F.concat(F.lit("part "), text("p_partkey", 64), F.lit(" "), text("p_partkey", 32), F.lit(" "), text("p_partkey", 251))))
    )


_BLOCKS_SQL = """
    WITH a AS (SELECT event_id, CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 6 ELSE 4 END AS family,
        CASE WHEN event_id % 3 = 0 THEN (536939960::HUGEINT << 96) + ((user_id % 64)::HUGEINT << 80) + event_id % 4096
          ELSE (167772160 + user_id % 64 * 65536 + event_id % 32 * 256 + event_id // 32 % 256)::HUGEINT END AS address FROM events),
    b AS (
      SELECT 4 AS family, 12 AS length, (167772160 + r_regionkey * 16 * 65536)::HUGEINT AS low, r_name AS owner FROM region WHERE r_regionkey < 2
      UNION ALL SELECT 6, 32, 536939960::HUGEINT << 96, r_name FROM region WHERE r_regionkey = 4
      UNION ALL SELECT 4, 16, (167772160 + n_nationkey * 65536)::HUGEINT, n_name FROM nation
      UNION ALL SELECT 6, 48, (536939960::HUGEINT << 96) + (n_nationkey::HUGEINT << 80), n_name FROM nation
      UNION ALL SELECT 4, 24, (167772160 + c_custkey % 64 * 65536 + c_nationkey * 256)::HUGEINT, 'customer ' || c_custkey % 64 || ' ' || c_nationkey FROM customer WHERE c_custkey % 2 = 0
      UNION ALL SELECT 6, 124, (536939960::HUGEINT << 96) + (s_nationkey::HUGEINT << 80) + s_suppkey % 4096 // 16 * 16, 'supplier ' || printf('%x', s_nationkey) || ' ' || s_suppkey % 4096 // 16 FROM supplier
      UNION ALL SELECT 4, 32, (167772160 + p_partkey % 64 * 65536 + p_partkey % 32 * 256 + p_partkey % 251)::HUGEINT, 'part ' || p_partkey % 64 || ' ' || p_partkey % 32 || ' ' || p_partkey % 251 FROM part),
    held AS (SELECT event_id, arg_max(owner, length) AS owner FROM a JOIN b ON a.family = b.family AND address >= low
      AND address < low + (1::HUGEINT << (CASE WHEN a.family = 4 THEN 32 ELSE 128 END - length)) GROUP BY 1)
"""


@query("filter_ip_blocks", _BLOCKS_SQL + " SELECT event_id, owner FROM events LEFT JOIN held USING (event_id)")
def filter_ip_blocks(t: Tables) -> DataFrame:
    """The owner of the longest block that holds each event's address, from a table of blocks of both families."""
    return longest_blocks(_mixed_addresses(t), "client", _block_table(t), "block").select("event_id", "owner")


@query(
    "filter_ip_families",
    _BLOCKS_SQL
    + """
    SELECT 'in blocks' AS test, count(*)::BIGINT AS n FROM a WHERE family = 4 AND address BETWEEN 167772160 AND 167837695 OR family = 6 AND address >> 96 = 536939960
    UNION ALL SELECT 'after block', count(*) FROM a WHERE family = 6 OR family = 4 AND address > 167837695
    UNION ALL SELECT 'in no known block', count(*) FROM events ANTI JOIN held USING (event_id)
    """,
)
def filter_ip_families(t: Tables) -> DataFrame:
    rows, client = _mixed_addresses(t), F.col("client")
    tests = {
        "in blocks": network.text_address_filter(client, "IN", ["10.0.0.0/16", "2001:db8::/32"]),
        "after block": network.text_address_filter(client, ">", ["10.0.0.0/16"]),
    }
    counts = rows.agg(*[F.count_if(c).alias(n) for n, c in tests.items()]).unpivot([], [F.col(f"`{n}`") for n in tests], "test", "n")
    outside = longest_blocks(rows, "client", _block_table(t), "block", "anti")
    return counts.union(outside.agg(F.lit("in no known block").alias("test"), F.count(F.lit(1)).alias("n")))
