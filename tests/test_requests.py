from __future__ import annotations

from datetime import datetime

import pytest
from fixtures import FRUIT, crates, texts
from pyspark.sql import functions as F

from marlstone.functions import grains, labels, network, timerange
from marlstone.functions.timerange import TimeRangeError, resolve
from marlstone.plans import builder, filters
from marlstone.plans.builder import compile_request
from marlstone.plans.request import Dataset, Dim, Filter, Metric, Request, RequestError, Rule, page_size, read_only_sql, sql_aggregate
from marlstone.plans.result_cache import ResultCache, request_key

NOW = datetime(2016, 11, 7, 9, 30, 10)
COUNT = Metric("n", "COUNT", "*")


def count(df, *filters, **options):
    return compile_request(Dataset(df), Request(metrics=[COUNT], filters=filters, **options), NOW).first()["n"]


def test_in_sentinels(spark):
    df = texts(spark)
    for value, wanted in ((["<NULL>"], 1), ([None], 1), (["<empty string>"], 1), ([""], 1), (["tea", "", None, "null"], 4)):
        assert count(df, Filter("word", "IN", value)) == wanted
    assert count(df, Filter("word", "IN", ['"in quotes"', "it's"])) == 2
    assert count(df, Filter("word", "NOT IN", ["tea", None])) == 6


def test_null_comparison(spark):
    df = crates(spark)
    assert count(df, Filter("note", "==", None)) == len(FRUIT)
    assert count(df, Filter("note", "!=", None)) == 0
    with pytest.raises(RequestError):
        count(df, Filter("note", ">", None))


def test_two_temporal_ranges(spark):
    filters = [
        Filter("packed", "TEMPORAL_RANGE", "2021-03-09 : 2021-03-11"), Filter("sold", "TEMPORAL_RANGE", "2021-06-18 : 2021-07-01"),
    ]
    request = Request(columns=["crate", "fruit"], metrics=None, filters=filters)
    assert [tuple(r) for r in compile_request(Dataset(crates(spark)), request, NOW).collect()] == [(4, "kiwi")]


def test_range_is_half_open(spark):
    days = ["2021-12-31", "2022-01-01", "2022-03-10", "2023-01-01", "2023-03-10"]
    df = spark.createDataFrame([(datetime.fromisoformat(d),) for d in days], "d timestamp_ntz")
    assert count(df, Filter("d", "TEMPORAL_RANGE", "2022-01-01 : 2023-01-01")) == 2
    as_text = df.select(F.date_format("d", "yyyy-MM-dd HH:mm:ss").alias("d"))
    assert count(as_text, Filter("d", "TEMPORAL_RANGE", "2022-01-01 : 2023-01-01")) == 2


def test_long_list_as_table(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("id"))
    many = list(range(5000))
    assert count(df, Filter("id", "IN", many)) == 4950
    assert count(df, Filter("id", "IN", [*many, None])) == 5050
    assert count(df, Filter("id", "NOT IN", many)) == 4950


def test_errors(spark):
    data = Dataset(crates(spark), metrics={"total": "sum(weight)"})
    for request in (
        Request(columns=["nope"], metrics=[COUNT]),
        Request(columns=["crate"], metrics=["unknown"]),
        Request(columns=["crate", "crate"], metrics=[COUNT]),
        Request(columns=["crate"], metrics=[COUNT], series_columns=["fruit"], series_limit=2),
        Request(metrics=[Metric("x", expr="(SELECT max(1))")]),
        Request(metrics=[Metric("x", "MEDIANISH", "crate")]),
        Request(metrics=[COUNT], filters=[Filter("crate", "ABOUT", 3)]),
        Request(metrics=[COUNT], time_offsets=["1 year ago"]),
        Request(metrics=[COUNT], post_processing=[("nope", {})]),
    ):
        with pytest.raises(RequestError):
            compile_request(data, request, NOW)
    assert count(crates(spark), Filter("not_there", "==", 1)) == len(FRUIT)


def test_where_must_be_one_expression(spark):
    with pytest.raises(Exception):
        count(crates(spark), where="crate = 1; DROP TABLE x")
    assert count(crates(spark), where="crate < 3 OR fruit = 'peach'") == 4


@pytest.mark.parametrize("text", ["DROP TABLE x", "SELECT 1; SELECT 2", "INSERT INTO x VALUES (1)", "CREATE TABLE x (i INT)"])
def test_virtual_dataset_is_read_only(spark, text):
    with pytest.raises(RequestError):
        Dataset.from_sql(spark, text)


def test_virtual_dataset(spark):
    assert Dataset.from_sql(spark, "SELECT 1 AS a -- note").df.first()["a"] == 1


def test_series_limit_ignores_the_shift(spark):
    rows = [(datetime(2020, 1, 1), "a", 1), (datetime(2020, 1, 1), "b", 5), (datetime(2021, 1, 1), "a", 9), (datetime(2021, 1, 1), "b", 2)]
    data = Dataset(spark.createDataFrame(rows, "t timestamp_ntz, k string, v int"), time_column="t")
    request = Request(
        columns=[Dim("year", "t", "P1Y"), "k"], metrics=[Metric("v", "SUM", "v")], series_columns=["k"], series_limit=1,
        time_range="2021-01-01 : 2022-01-01", time_offsets=["1 year ago"],
    )
    out = compile_request(data, request, NOW).collect()
    assert [(r["k"], r["v"], r["v__1 year ago"]) for r in out] == [("a", 9, 1)]


def test_row_security():
    from marlstone.plans.request import security_clauses

    rules = [
        Rule("a = 1", frozenset({"x"}), group="g"), Rule("a = 2", frozenset({"x"}), group="g"),
        Rule("b = 1", frozenset({"admin"}), kind="base"), Rule("c = 1", frozenset({"other"})),
    ]
    assert security_clauses(rules, ["x"]) == ["((a = 1) OR (a = 2))", "((b = 1))"]
    assert security_clauses(rules, ["x", "admin"]) == ["((a = 1) OR (a = 2))"]


def test_cache(spark, tmp_path):
    cache = ResultCache(spark, str(tmp_path))
    data = Dataset(crates(spark))
    request = Request(metrics=[COUNT])
    first = cache.answer("p", data, request, NOW).collect()
    assert cache.answer("p", data, request, NOW).collect() == first and cache.hits == 1
    other = Request(metrics=[COUNT], filters=[Filter("crate", ">", 5)])
    assert cache.answer("p", data, other, NOW).first()["n"] == 6 and cache.hits == 1
    assert request_key("a", request) != request_key("b", request)
    assert request_key("a", request, ("r",)) != request_key("a", request)


def test_cache_knows_the_day_and_survives_dead_writes(spark, tmp_path):
    cache = ResultCache(spark, str(tmp_path))
    data = Dataset(spark.sql("SELECT explode(sequence(timestamp_ntz'1995-01-01', timestamp_ntz'2001-12-01', interval 1 month)) AS t"), time_column="t")
    request = Request(metrics=[COUNT], time_range="Last year")
    years = {}
    for year in (1998, 1999, 2005):
        years[year] = cache.answer("p", data, request, datetime(year, 6, 1)).first()["n"]
    assert cache.hits == 0 and years[1998] == years[1999] > years[2005]
    key = next(tmp_path.iterdir())
    (next(key.iterdir()) / "_SUCCESS").unlink()  # as if the write had died
    for _ in range(2):
        for year in years:
            assert cache.answer("p", data, request, datetime(year, 6, 1)).first()["n"] == years[year]
    assert cache.hits == 5


def test_limits_are_those_asked_for(spark):
    assert page_size(None) == 1000 and page_size(5000) == 5000
    with pytest.raises(RequestError):
        page_size(0)
    wide = Dataset(spark.range(300_500))
    assert compile_request(wide, Request(columns=["id"], row_limit=300_000), NOW).count() == 300_000


def test_no_subquery_in_a_metric_and_no_second_statement(spark):
    for text in ("max((select 1))", "max(( /* x */ select 1))", "max((--\n select 1))", "max((with a as (select 1) select * from a))"):
        with pytest.raises(RequestError):
            sql_aggregate(text)
    sql_aggregate("count(if(name = '(select', 1, null))")
    for text in ("SELECT 1 AS a) UNION ALL SELECT * FROM (SELECT 2 AS a", "SELECT 1; SELECT 2"):
        with pytest.raises(RequestError):
            read_only_sql(spark, text)
    assert read_only_sql(spark, "SELECT ')' AS a -- )").first()["a"] == ")"


@pytest.mark.parametrize("values, kind", [([0.5, 1.0, 2.0], "bigint"), ([True, 3], "bigint"), ([1, 2.5], "double"), (["3", 4], "string")])
@pytest.mark.parametrize("op", ["IN", "NOT IN"])
def test_long_lists_mean_what_short_ones_mean(spark, monkeypatch, values, kind, op):
    data = Dataset(spark.range(8).select(F.when(F.col("id") < 7, F.col("id")).cast(kind).alias("c")))
    request = Request(columns=["c"], filters=[Filter("c", op, values)])
    short = compile_request(data, request, NOW).collect()
    monkeypatch.setattr(filters, "LIST_AS_TABLE", 0)
    assert sorted(map(repr, compile_request(data, request, NOW).collect())) == sorted(map(repr, short))


def test_labels():
    assert labels.unique(["foo", "bar", "foo", "foo"]) == ["foo", "bar", "foo__1", "foo__2"]
    assert labels.unique(["x", "x__1", "x"])[2] not in ("x", "x__1")
    assert labels.flatten(["a, b", None, "c"]) == "a\\, b, c" and labels.unescape("a\\, b") == "a, b"


def d(text):
    return datetime.fromisoformat(text) if text else None


@pytest.mark.parametrize(
    "text, since, until",
    [
        (None, None, "2016-11-07"),
        (" : now", None, "2016-11-07 09:30:10"),
        ("yesterday : tomorrow", "2016-11-06", "2016-11-08"),
        ("2018-01-01T00:00:00 : 2018-12-31T23:59:59", "2018-01-01", "2018-12-31 23:59:59"),
        ("Last year", "2015-11-07", "2016-11-07"),
        ("Last quarter", "2016-08-07", "2016-11-07"),
        ("Last 5 months", "2016-06-07", "2016-11-07"),
        ("Last 1 month", "2016-10-07", "2016-11-07"),
        ("Next 5 months", "2016-11-07", "2017-04-07"),
        ("Next 1 month", "2016-11-07", "2016-12-07"),
        ("5 days : ", "2016-11-02", None),
        ("previous calendar week", "2016-10-31", "2016-11-07"),
        ("previous calendar month", "2016-10-01", "2016-11-01"),
        ("previous calendar year", "2015-01-01", "2016-01-01"),
        ("No filter", None, None),
        ("DATEADD(DATETIME('2016-11-07'), -2, DAY) : DATETRUNC(DATETIME('now'), YEAR)", "2016-11-05", "2016-01-01"),
    ],
)
def test_time_ranges(text, since, until):
    if text and text.endswith("YEAR)"):
        with pytest.raises(TimeRangeError):
            resolve(text, NOW)
        return
    assert resolve(text, NOW) == (d(since), d(until))


def test_time_range_options():
    assert resolve("yesterday : tomorrow", NOW, "1 day") == (d("2016-11-05"), d("2016-11-07"))
    assert resolve("Last week", NOW, relative_end="now") == (d("2016-10-31"), d("2016-11-07 09:30:10"))
    with pytest.raises(TimeRangeError):
        resolve("tomorrow : yesterday", NOW)


def test_date_functions():
    ev = timerange.evaluate
    assert ev("LASTDAY(DATETIME('2000-01-15'), MONTH)", NOW) == d("2000-01-31")
    assert ev("LASTDAY(DATETIME('2000-01-15'), WEEK)", NOW) == d("2000-01-16")
    assert ev("DATETRUNC(DATETIME('2018-05-15'), QUARTER)", NOW) == d("2018-04-01")
    assert ev("HOLIDAY('new year', DATETIME('2018-12-29'))", NOW) == d("2018-01-01")
    assert ev("HOLIDAY('thanksgiving', DATETIME('2016-01-01'))", NOW) == d("2016-11-24")
    assert ev("HOLIDAY('Memorial', DATETIME('2016-01-01'))", NOW) == d("2016-05-30")


def test_sunday_stays_in_its_week(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 5),)], "d timestamp_ntz")
    c = F.col("d")
    row = df.select(
        grains.bucket(c, grains.WEEK_STARTING_SUNDAY).alias("a"), grains.bucket(c, grains.WEEK_ENDING_SATURDAY).alias("b"),
        grains.bucket(c, grains.WEEK_ENDING_SUNDAY).alias("c"),
    ).first()
    assert (row["a"], row["b"], row["c"]) == (d("2020-01-05"), d("2020-01-11"), d("2020-01-05"))


def test_offset_keys(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 7),)], "d timestamp_ntz")
    keys = [grains.offset_key(F.col("d"), g) for g in ("P1W", "P1M", "P3M", "P1Y")]
    assert tuple(df.select(*keys).first()) == ("2020-W01", "2020-01", "2020-Q1", "2020")


def test_address_bounds(spark):
    nums = spark.createDataFrame([(n,) for n in (16843007, 16843008, 16843100, 16843263, 16843264)], "n long")
    kept = {op: nums.filter(network.address_filter(F.col("n"), op, ["1.1.1.0/24"])).count() for op in (">=", ">", "<=", "<", "==", "!=")}
    assert kept == {">=": 2, ">": 1, "<=": 2, "<": 1, "==": 3, "!=": 2}
    with pytest.raises(ValueError):
        network.address_filter(F.col("n"), ">", ["1.1.1.1", "1.1.1.2"])


def test_addresses(spark):
    assert network.address_range("1.1.1.1") == (16843009, 16843009)
    assert network.address_range("1.1.1.0/24") == (16843008, 16843263)
    with pytest.raises(ValueError, match="no address"):
        network.address_range("abc")
    df = spark.createDataFrame([("1.1.1.1",), ("1.1.1",), ("256.1.1.1",), (None,)], "a string")
    assert [r[0] for r in df.select(network.address_number(F.col("a"))).collect()] == [16843009, None, None, None]
    nums = spark.createDataFrame([(16843007,), (16843009,), (16843300,)], "n long")
    assert nums.filter(network.address_filter(F.col("n"), "NOT IN", ["1.1.1.0/24"])).count() == 2


def test_ports():
    assert network.ports_of("http") == [80] and network.ports_of("ftp") == [20, 21] and network.ports_of("443") == [443]
    for bad in ("abc", "123456", "0"):
        with pytest.raises(ValueError, match="no port"):
            network.ports_of(bad)


def test_result_times_and_infinities(spark):
    df = spark.createDataFrame([("2017-07-01T00:00:00.000Z", float("inf"), "5.5")], "t string, v double, m string")
    row = builder.normalise(df, {"t": "%Y-%m-%d"}, ["m"], hours=1, time_shift="1 day").first()
    assert (row["t"], row["v"], row["m"]) == (datetime(2017, 7, 2, 1), None, 5.5)
