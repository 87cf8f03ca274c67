"""Session, shared storage and lineage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "marlstone", cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only used when the whole application runs in one
    process (``local[...]``); on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_DIR:
        _LOCAL_DIR[app] = tempfile.mkdtemp(prefix="marlstone-")
    return _LOCAL_DIR[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/marlstone/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by writing ``df`` once and reading it back.

    One pass over the plan (a reliable RDD checkpoint computes it twice), the
    result survives lost executors, and readers get columnar pruning.
    """
    path = scratch_path(df.sparkSession, label)
    with _shuffles_end(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles meanwhile goes with its end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    if before == "true":
        # The user's own choice, or that of another thread, which sets it back.
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def discard(df: DataFrame) -> None:
    """Remove what ``materialise`` wrote for ``df``, once no reader is left."""
    session = df.sparkSession
    for name in df.inputFiles()[:1]:
        folder = session._jvm.org.apache.hadoop.fs.Path(name).getParent()
        if folder.getParent().getName() == "marlstone":
            folder.getFileSystem(session._jsc.hadoopConfiguration()).delete(folder, True)
