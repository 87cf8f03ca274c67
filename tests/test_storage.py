from __future__ import annotations

import glob
import json
from types import SimpleNamespace
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from marlstone.operators import alerts
from marlstone.session import materialise, scratch_path, shared_dir
from marlstone.plans import builder
from marlstone.sources import datasets, files, jdbc, synthetic


def name(label):
    return f"t_{label}_{uuid4().hex[:10]}"


def test_upload_options(spark, tmp_path):
    text = 'made by hand\nsecond line\nid; amount;day;flag\n1; 1,5;31/12/2020;NA\n\n2; 2,25;01/02/2021;y\n3; x;bad;n\n'
    (tmp_path / "up.csv").write_text(text)
    df = files.read_upload(
        spark, str(tmp_path / "up.csv"), sep=";", decimal=",", skip_rows=2, skip_initial_space=True, null_values=["NA", "x"],
        dates=["day"], day_first=True, types={"id": "int", "amount": "double"}, use_columns=["id", "amount", "day", "flag"],
    )
    rows = [(r["id"], r["amount"], str(r["day"])[:10], r["flag"]) for r in df.orderBy("id").collect()]
    assert rows == [(1, 1.5, "2020-12-31", None), (2, 2.25, "2021-02-01", "y"), (3, None, "None", "n")]
    limited = files.read_upload(spark, str(tmp_path / "up.csv"), sep=";", skip_rows=2, rows=1, index_label="i")
    assert limited.count() == 1 and limited.columns[0] == "i"


def test_upload_of_several_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(3):
        (folder / f"f{k}.csv").write_text(f"note {k}\nid,v\n{k}0,a\n{k}1,b\n")
    df = files.read_upload(spark, str(folder), skip_rows=1, index_label="i")
    assert [tuple(r) for r in df.orderBy("i").collect()] == [(n, f"{n // 2}{n % 2}", "ab"[n % 2]) for n in range(6)]
    bare = files.read_upload(spark, str(folder), skip_rows=2, header=False, index_label="i", rows=3)
    assert [tuple(r) for r in bare.orderBy("i").collect()] == [(0, "00", "a"), (1, "01", "b"), (2, "10", "a")]


def test_upload_keeps_rows_of_nulls_and_counts_from_zero(spark, tmp_path):
    lines = ["a,b"] + [f"{k},x" for k in range(2000)] + [",", ""]
    (tmp_path / "n.csv").write_text("\n".join(lines) + "\n")
    df = files.read_upload(spark, str(tmp_path / "n.csv"), index_label="i")
    assert df.count() == 2001 and df.filter("a IS NULL AND b IS NULL").count() == 1
    assert df.filter("i <> a").count() == 0 and df.agg(F.max("i")).first()[0] == 2000


def test_newest_partition_of_several_keys(spark, tmp_path):
    table = name("hours")
    rows = [("2024-01-01", 9), ("2024-01-02", 9), ("2024-01-02", 10)]
    spark.createDataFrame(rows, "day string, hour int").withColumn("v", F.lit(1)).write.partitionBy("day", "hour").option("path", str(tmp_path / "h")).saveAsTable(table)
    assert files.latest_partitions(spark, table) == {"day": "2024-01-02", "hour": "10"}
    assert [(r["day"], r["hour"]) for r in files.at_latest_partition(spark, table).collect()] == [("2024-01-02", 10)]


def test_formula_guard(spark):
    texts = ["=1", " =1", '""=1', "-1.5", "--1", "-1a", "a=1", "|x", " | x", "", None, "-", "%", "  ", "+1"]
    guarded = ["=1", " =1", '""=1', "--1", "-1a", "|x", " | x", "-", "%", "+1"]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select("t", files.escape_cell(F.col("t")).alias("e")).collect()
    for r in out:
        want = "'" + r["t"].replace("|", "\\|") if r["t"] in guarded else r["t"]
        assert r["e"] == want
        if r["t"] is not None:
            assert files.escape_name(r["t"]) == want


def test_repeated_header_names(spark, tmp_path):
    (tmp_path / "d.csv").write_text("a,b,c\n1,2,3\n")
    assert files.read_upload(spark, str(tmp_path / "d.csv"), header=False).columns == ["_c0", "_c1", "_c2"]


def test_table_modes(spark, tmp_path):
    table, df = name("modes"), spark.range(3)
    files.store_table(df, table, "fail", str(tmp_path / "t"))
    with pytest.raises(files.TableExists):
        files.store_table(df, table, "fail")
    files.store_table(df, table, "append", str(tmp_path / "t"))
    assert spark.table(table).count() == 6
    files.store_table(spark.range(1), table, "replace", str(tmp_path / "t"))
    assert spark.table(table).count() == 1
    assert files.frame_schema({"a": "bool", "b": "float64", "c": "int64", "d": "object", "e": "category"}) == (
        "`a` boolean, `b` double, `c` bigint, `d` string, `e` string"
    )


def test_partitions_appear_after_sync(spark, tmp_path):
    table, path = f"t_silver.{name('ext')}", str(tmp_path / "ext")
    df = spark.range(3).select("id", F.concat(F.lit("2024-01-0"), (F.col("id") + 1).cast("string")).alias("part_day"))
    files.write_partitioned(df, path, ["part_day"])
    files.create_external(spark, table, df.schema, ["part_day"], path)
    assert spark.table(table).count() == 0
    files.sync_partitions(spark, table)
    assert spark.table(table).count() == 3
    assert files.latest_partition(spark, table) == "2024-01-03"
    assert [r["id"] for r in files.at_latest_partition(spark, table).collect()] == [2]


def test_unpartitioned_table_is_not_filtered(spark, tmp_path):
    table = name("flat")
    files.store_table(spark.range(4), table, "fail", str(tmp_path / "flat"))
    assert files.latest_partition(spark, table) is None and files.at_latest_partition(spark, table).count() == 4


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    a, b = name("a"), name("b")
    files.write_bucketed(spark.range(100).select("id", (F.col("id") % 7).alias("v")), a, 4, "id", "id", str(tmp_path / "a"))
    files.write_bucketed(spark.range(100).select(F.col("id").alias("k")), b, 4, "k", "k", str(tmp_path / "b"))
    joined = spark.table(a).join(spark.table(b).hint("merge"), F.col("id") == F.col("k"))
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100


def test_hot_partition_is_spread_over_files(spark, tmp_path):
    df = spark.range(10_000).select("id", F.lit("one").alias("day"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_partitioned(df, str(tmp_path / "hot"), ["day"], files=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(str(tmp_path / "hot/day=one/*.parquet"))) > 1


def test_escaped_cells(spark):
    cells = {
        "value": "value", "-10": "-10", "@value": "'@value", "+value": "'+value", "-value": "'-value", "=value": "'=value",
        "|value": "'\\|value", "%value": "'%value", "=cmd|' /C calc'!A0": "'=cmd\\|' /C calc'!A0", '""=10+2': '\'""=10+2',
        " =10+2": "' =10+2",
    }
    df = spark.createDataFrame([(k, v) for k, v in cells.items()], "v string, want string")
    for r in files.escaped_csv(df).collect():
        assert r["v"] == cells[[k for k, w in cells.items() if w == r["v"]][0]]
    assert files.escape_name("=a|b") == "'=a\\|b" and files.escape_name("-1") == "-1"


def test_json_array_documents(spark, tmp_path):
    station = {
        "stationcode": "1", "capacity": 0, "numbikesavailable": 3, "duedate": "2024-01-02T10:11:12+00:00", "code_insee_commune": "x",
        "nom_arrondissement": None, "coordonnees_geo": {"lat": 1.5, "lon": 2.5},
    }
    (tmp_path / "10-11.json").write_text(json.dumps([station, {**station, "capacity": 6, "stationcode": "2"}]))
    out = files.silver(files.scan_json(spark, str(tmp_path / "*.json"), array=True), "2024-01-01").orderBy("stationcode").collect()
    assert [r["fill_ratio"] for r in out] == [None, 0.5]
    assert (out[0]["part_day"], out[0]["part_minute"], out[0]["lat"], out[0]["lon"]) == ("2024-01-02", "2024-01-02T10:11", 1.5, 2.5)
    assert not {"coordonnees_geo", "code_insee_commune", "nom_arrondissement"} & set(out[0].asDict())


def test_jdbc_options():
    options = jdbc.reader_options("jdbc:x", "t", user="u", split=("id", 0, 100, 8), custom_schema="id BIGINT")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["customSchema"] == "id BIGINT"
    assert "password" not in options


def test_random_columns_do_not_depend_on_partitions(spark):
    key = F.col("id")
    def build(df):
        return df.select(
            "id", synthetic.normal(key, 1).alias("n"), synthetic.poisson(key, 2, 4.0).alias("p"),
            synthetic.gamma(key, 3, 2.5, 2.0).alias("g"), synthetic.exponential(key, 4, 3.0).alias("e"),
            synthetic.log_normal(key, 5, 2.0, 0.5).alias("l"), synthetic.uniform(key, 6).alias("u"),
        )

    a, b = build(spark.range(20_000)), build(spark.range(20_000).repartition(3))
    assert a.exceptAll(b).isEmpty()
    m = a.agg(*[F.avg(c).alias(c) for c in a.columns], F.var_samp("p").alias("vp"), F.var_samp("g").alias("vg"), F.stddev("l").alias("sl")).first()
    assert m["n"] == pytest.approx(0, abs=0.03) and m["p"] == pytest.approx(4, abs=0.06) and m["vp"] == pytest.approx(4, abs=0.2)
    assert m["g"] == pytest.approx(5, abs=0.1) and m["vg"] == pytest.approx(10, abs=0.7) and m["e"] == pytest.approx(3, abs=0.1)
    assert m["l"] == pytest.approx(2, abs=0.02) and m["sl"] == pytest.approx(0.5, abs=0.02) and m["u"] == pytest.approx(0.5, abs=0.01)


def test_synthetic_table(spark):
    df = synthetic.synthetic_table(spark, 500, [("a", "integer", False), ("b", "time", True), ("c", "string", True)], seed=3)
    assert df.count() == 500 and df.columns == ["a", "b", "c"]
    assert 20 < df.filter("b IS NULL").count() < 90 and df.filter("b IS NOT NULL AND b NOT RLIKE '^[0-2][0-9]:[0-5][0-9]:[0-5][0-9]$'").count() == 0
    assert len(synthetic.wide_columns(100)) == 100


def test_alerts(spark):
    one = spark.createDataFrame([(5.0,)], "v double")
    assert alerts.operator_alert(one, ">", 4) and not alerts.operator_alert(one, "<", 4) and alerts.not_null_alert(one)
    empty = one.limit(0)
    assert alerts.operator_alert(empty, "==", 0) and not alerts.not_null_alert(empty)
    for value in (0.0, None, float("nan")):
        df = spark.createDataFrame([(value,)], "v double")
        assert not alerts.not_null_alert(df) and alerts.operator_alert(df, "==", 0)
    with pytest.raises(alerts.AlertError):
        alerts.operator_alert(one.unionAll(one), ">", 4)
    with pytest.raises(alerts.AlertError):
        alerts.operator_alert(one.select("v", F.lit(1).alias("w")), ">", 4)
    with pytest.raises(alerts.AlertError):
        alerts.operator_alert(spark.createDataFrame([("x",)], "v string"), ">", 4)


def session_like(master, folder):
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(session_like("spark://host", "s3a://bucket/shared/")) == "s3a://bucket/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session_like("spark://host", None))
    path = scratch_path(spark, "five")
    assert path.startswith(shared_dir(spark)) and path != scratch_path(spark, "five")
    out = materialise(spark.range(5).filter("id > 1"), "few")
    assert out.count() == 3 and "Range" not in out._jdf.queryExecution().logical().toString()


def test_example_datasets(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,7,4.5,0\n2,7,bad,86400\n")
    out = datasets.load_dataset(spark, "ratings", str(tmp_path / "ratings.csv")).orderBy("userId").collect()
    assert (out[0]["rating"], out[1]["rating"], str(out[1]["timestamp"])) == (4.5, None, "1970-01-02 00:00:00")
    line = {
        "ds": "2020-01-02", "ds2": "2020-01-02 03:04:05", "epoch_s": 1577934245, "epoch_ms": 1577934245000, "string0": "2020-01-02 03:04:05",
        "string1": "2020-01-02", "string2": "20200102030405", "string3": "2020/01/0203:04:05",
    }
    (tmp_path / "times.json").write_text(json.dumps(line))
    df = datasets.load_dataset(spark, "multiformat_time", str(tmp_path / "times.json"), "json")
    row = builder.normalise(df, {"epoch_s": "epoch_s", "epoch_ms": "epoch_ms", **datasets.TEXT_TIMES}).first()
    full = [row[c] for c in ("ds2", "epoch_s", "epoch_ms", "string0", "string2", "string3")]
    assert len(set(full)) == 1 and str(row["string1"]) == "2020-01-02 00:00:00"
    with pytest.raises(ValueError):
        datasets.load_dataset(spark, "nope", "x")
