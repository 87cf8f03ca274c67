"""Reading and writing files and tables."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import unique
from ..operators.ordered import Running, running


class TableExists(ValueError):
    """The table is there and may not be replaced."""


# --- scans -----------------------------------------------------------------


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, array: bool = False) -> DataFrame:
    """JSON documents by path or glob; ``array`` files hold one array each."""
    reader = spark.read.option("multiLine", array)
    return (reader.schema(schema) if schema else reader).json(path)


def scan_csv(
    spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None, infer: bool = False
) -> DataFrame:
    reader = spark.read.option("header", True).option("sep", sep).option("inferSchema", infer)
    return (reader.schema(schema) if schema else reader).csv(path)


def count_lines_with(lines: DataFrame, tokens: Sequence[str], column: str = "value") -> DataFrame:
    """Lines holding each token, from one pass over the text."""
    counts = lines.agg(*[F.count_if(F.col(column).contains(t)).alias(f"__t{i}") for i, t in enumerate(tokens)])
    pairs = [F.struct(F.lit(t).alias("token"), F.col(f"__t{i}").alias("lines")) for i, t in enumerate(tokens)]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def scan_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def sql_on_file(spark: SparkSession, path: str, columns: Sequence[str], style: str = "parquet") -> DataFrame:
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT {names} FROM {style}.`{path}`")


def json_columns(df: DataFrame, column: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON text to columns."""
    parsed = df.select(*keep, F.from_json(column, schema).alias("__j"))
    return parsed.select(*keep, "__j.*")


def point_columns(column: str) -> tuple[Column, Column]:
    return F.col(f"{column}.lat").alias("lat"), F.col(f"{column}.lon").alias("lon")


# --- uploads ---------------------------------------------------------------


def read_upload(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    decimal: str = ".",
    header: bool = True,
    skip_rows: int = 0,
    rows: int | None = None,
    use_columns: Sequence[str] | None = None,
    null_values: Sequence[str] = (),
    dates: Sequence[str] = (),
    day_first: bool = False,
    types: dict[str, str] | None = None,
    skip_initial_space: bool = False,
    skip_blank_lines: bool = True,
    index_label: str | None = None,
) -> DataFrame:
    """A delimited file, or a folder of such files, with the options of the upload form.

    Lines to skip are skipped in each file.  Blank lines never become rows; a
    line of separators only is a row of nulls.  The index counts from 0 over
    all files, by name and position, before ``rows`` cuts.
    """
    if skip_rows:
        df = _after_skipped(spark, path, sep, header, skip_rows, skip_initial_space)
    else:
        df = _with_place(
            spark.read.option("header", header).option("sep", sep)
            .option("ignoreLeadingWhiteSpace", skip_initial_space).csv(path)
        )
    names = [c for c in df.columns if c not in _PLACE]
    df = df.toDF(*unique(names), *_PLACE)
    if index_label:
        df = running(df, [], [(c, True) for c in _PLACE], {"__index": Running("row_number")})
    df = df.orderBy(*_PLACE).limit(rows) if rows else df
    index = [(F.col("__index") - 1).alias(index_label)] if index_label else []
    wanted = use_columns or unique(names)
    df = df.select(*index, *[F.col(f"`{c}`") for c in wanted])
    if null_values:
        df = df.select(*[F.col(f"`{c}`") if c == index_label else F.when(~F.col(f"`{c}`").isin(*null_values), F.col(f"`{c}`")).alias(c) for c in df.columns])
    changed: dict[str, Column] = {}
    for name, kind in (types or {}).items():
        source = F.col(f"`{name}`")
        if decimal != "." and kind in ("double", "float"):
            source = F.regexp_replace(source, f"\\{decimal}", ".")
        changed[name] = source.cast(kind)
    for name in dates:
        source = F.col(f"`{name}`")
        first = ("d/M/yyyy", "d-M-yyyy") if day_first else ("M/d/yyyy", "M-d-yyyy")
        tries = [source.try_cast("timestamp_ntz")]
        tries += [F.try_to_timestamp(source, F.lit(p)).cast("timestamp_ntz") for p in first]
        changed[name] = F.coalesce(*tries)
    df = df.withColumns(changed) if changed else df
    return df


#: Where a line stands: its file, the block of the file, its number in the task that reads the block.
_PLACE = ("__file", "__block", "__line")


def _with_place(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__line"))


def _after_skipped(spark: SparkSession, path: str, sep: str, header: bool, skip: int, trim: bool) -> DataFrame:
    """The rows of every file after its first ``skip`` lines and, with ``header``, the line of names."""
    lines = _with_place(spark.read.text(path).filter(F.length(F.trim("value")) > 0))
    by_file = Window.partitionBy("__file").orderBy("__block", "__line")
    top = lines.withColumn("__n", F.row_number().over(by_file)).filter(F.col("__n") <= skip + 1)
    start = top.filter(F.col("__n") == skip + 1).select("__file", F.struct("__block", "__line").alias("__first"), F.col("value").alias("__names"))
    first = start.orderBy("__file").limit(1).collect()
    names = next(csv.reader([first[0]["__names"]], delimiter=sep, skipinitialspace=trim)) if first else []
    names = unique([n or f"_c{i}" for i, n in enumerate(names)]) if header else [f"_c{i}" for i in range(len(names))]
    place = F.struct("__block", "__line")
    body = lines.join(start, "__file").filter(place > F.col("__first") if header else place >= F.col("__first"))
    schema = ", ".join(f"`{n}` string" for n in names)
    options = {"sep": sep, "ignoreLeadingWhiteSpace": str(trim).lower()}
    return body.select(F.from_csv("value", schema, options).alias("r"), *_PLACE).select("r.*", *_PLACE)


def upload_csv(spark: SparkSession, path: str, table: str, if_exists: str = "fail", location: str | None = None, **options) -> None:
    store_table(read_upload(spark, path, **options), table, if_exists, location)


def read_parquet_upload(spark: SparkSession, paths: Sequence[str], use_columns: Sequence[str] | None = None) -> DataFrame:
    """One or several Parquet files under each other."""
    out: DataFrame | None = None
    for path in paths:
        part = spark.read.parquet(path)
        part = part.select(*[F.col(f"`{c}`") for c in use_columns]) if use_columns else part
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


# Frame types and the table types they become.
TABLE_TYPES = {"bool": "boolean", "float64": "double", "int64": "bigint", "object": "string"}


def frame_schema(dtypes: dict[str, str]) -> str:
    return ", ".join(f"`{n}` {TABLE_TYPES.get(t, 'string')}" for n, t in dtypes.items())


def store_table(df: DataFrame, table: str, if_exists: str = "fail", location: str | None = None) -> None:
    """Write a table: ``fail`` when it exists, ``replace`` or ``append``."""
    spark = df.sparkSession
    if if_exists not in ("fail", "replace", "append"):
        raise ValueError(f"unknown mode {if_exists}")
    if if_exists == "fail" and spark.catalog.tableExists(table):
        raise TableExists(f"table {table} already exists")
    writer = df.write.mode("append" if if_exists == "append" else "overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


# --- sinks -----------------------------------------------------------------


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], dynamic: bool = False, files: int | None = None) -> None:
    """Partitioned Parquet with few files per partition.

    Rows are dealt by partition and the engine cuts a hot one by its size, so
    it becomes several files; with ``files`` every partition is spread over so
    many by a salt.
    """
    if files:
        df = df.repartition(*[F.col(c) for c in by], F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    else:
        df = df.hint("rebalance", *by)
    mode = "dynamic" if dynamic else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by).parquet(path)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header; for results that are already small (aggregates, top-n).

    Only the finished rows go to one task, the work before them does not.
    """
    df.repartition(1).write.mode("overwrite").csv(path, header=True)


def write_orc(df: DataFrame, path: str, bloom: Sequence[str] = (), dictionary_threshold: float = 1.0) -> None:
    df.write.mode("overwrite").format("orc").option("orc.bloom.filter.columns", ",".join(bloom)).option(
        "orc.dictionary.key.threshold", str(dictionary_threshold)
    ).save(path)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, by: str, sort_by: str, location: str, partition_by: Sequence[str] = ()
) -> None:
    writer = df.write.mode("overwrite").format("parquet").option("path", location).bucketBy(buckets, by).sortBy(sort_by)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


# Fixed by the file format: a cell that begins with one of these is run as a formula.
FORMULA_STARTS = ("-", "@", "+", "|", "=", "%")


def _unpadded(text: Column) -> Column:
    """The text without what a reader skips at its beginning: an empty pair of quotes, or blanks."""
    return F.when(F.startswith(text, F.lit('""')), F.substring(text, F.lit(3), F.length(text))).otherwise(F.regexp_replace(text, r"^\s+", ""))


def _is_formula(text: Column) -> Column:
    number = F.startswith(text, F.lit("-")) & (F.length(text) > 1) & (F.translate(F.substring(text, F.lit(2), F.length(text)), "0123456789.", "") == "")
    return F.substring(_unpadded(text), 1, 1).isin(*FORMULA_STARTS) & ~number


def escape_cell(c: Column) -> Column:
    """Guard a text that a spreadsheet would run as a formula; negative numbers stay."""
    return F.when(_is_formula(c), F.concat(F.lit("'"), F.replace(c, F.lit("|"), F.lit("\\|")))).otherwise(c)


def escape_name(name: str) -> str:
    """The same for the name of a column."""
    shown = name[2:] if name.startswith('""') else name.lstrip()
    number = len(name) > 1 and name[0] == "-" and not name[1:].strip("0123456789.")
    if shown[:1] not in FORMULA_STARTS or number:
        return name
    return "'" + name.replace("|", "\\|")


def escaped_csv(df: DataFrame) -> DataFrame:
    """Escape every text cell and the header."""
    return df.select(
        *[
            (escape_cell(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")).alias(
                escape_name(f.name)
            )
            for f in df.schema.fields
        ]
    )


# --- tables and partitions -------------------------------------------------


def create_external(
    spark: SparkSession, table: str, df_schema: T.StructType, partitioned_by: Sequence[str], location: str
) -> None:
    """External partitioned table over existing files; errors are raised."""
    schema, name = table.split(".")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df_schema.fields)
    parts = ", ".join(partitioned_by)
    spark.sql(f"CREATE TABLE {schema}.{name} ({columns}) USING parquet PARTITIONED BY ({parts}) LOCATION '{location}'")


def sync_partitions(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)


def latest_partition(spark: SparkSession, table: str, column: str | None = None) -> str | None:
    """Value of ``column`` (the first partition column) in the newest partition; None when unpartitioned."""
    newest = latest_partitions(spark, table)
    if not newest:
        return None
    return newest[column] if column else next(iter(newest.values()))


def latest_partitions(spark: SparkSession, table: str) -> dict[str, str | None]:
    """All keys of the newest partition, from the catalogue only: newest by the first key, then the next."""
    parted = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not parted:
        return {}
    types = spark.table(table).schema
    texts = [F.url_decode(F.regexp_extract("partition", rf"(?:^|/){c}=([^/]+)", 1)) for c in parted]
    texts = [F.when(t != "__HIVE_DEFAULT_PARTITION__", t) for t in texts]
    # compared as the columns' types, so that hour 10 comes after hour 9
    newest = F.max_by(F.struct(*[t.alias(c) for t, c in zip(texts, parted)]), F.struct(*[t.cast(types[c].dataType) for t, c in zip(texts, parted)]))
    found = spark.sql(f"SHOW PARTITIONS {table}").agg(newest.alias("v")).first()["v"]
    return found.asDict() if found else {}


def at_latest_partition(spark: SparkSession, table: str) -> DataFrame:
    """The table filtered to its newest partition (literals, so files are pruned)."""
    df = spark.table(table)
    for column, value in latest_partitions(spark, table).items():
        df = df.filter(F.col(column).eqNullSafe(F.lit(value).cast(df.schema[column].dataType)))
    return df


def create_as(df: DataFrame, table: str, location: str, style: str = "parquet") -> DataFrame:
    """CREATE TABLE AS SELECT."""
    df.write.format(style).option("path", location).saveAsTable(table)
    return df.sparkSession.table(table)


def temporary_name(user: str, at: str) -> str:
    return f"tmp_{user}_table_{at}"


# --- bronze to silver ------------------------------------------------------

STATION_DROPPED = ("code_insee_commune", "nom_arrondissement", "coordonnees_geo")


def silver(bronze: DataFrame, since: str | None = None) -> DataFrame:
    """Station snapshots: fill ratio, position, day and minute; three columns dropped."""
    out = bronze.withColumns(
        {
            "fill_ratio": F.try_divide(F.col("numbikesavailable"), F.col("capacity")),
            "part_day": F.substring("duedate", 1, 10),
            "part_minute": F.substring("duedate", 1, 16),
            "lat": F.col("coordonnees_geo.lat"),
            "lon": F.col("coordonnees_geo.lon"),
        }
    ).drop(*STATION_DROPPED)
    return out.filter(F.col("part_day") >= since) if since else out
