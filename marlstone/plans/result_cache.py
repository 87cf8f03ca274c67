"""Answers kept by a key of the normalised request."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, is_dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..functions.timerange import resolve
from ..session import shared_dir
from .builder import compile_request
from .request import Dataset, Request


def _plain(value):
    if is_dataclass(value):
        return {type(value).__name__: _plain(asdict(value))}
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in sorted(value.items(), key=lambda kv: str(kv[0]))}
    if isinstance(value, (set, frozenset)):
        return sorted(_plain(v) for v in value)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value if isinstance(value, (str, int, float, bool, type(None))) else str(value)


def request_key(source: str, request: Request, roles: tuple[str, ...] = (), bounds: tuple = ()) -> str:
    """Key of a request; ``bounds`` are the ends that its time ranges mean just now."""
    text = json.dumps([source, sorted(roles), _plain(request), _plain(bounds)], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


def resolved_bounds(dataset: Dataset, request: Request, now: datetime) -> tuple:
    """Both ends of the time range and of every range among the filters, as of ``now``."""
    texts = [request.time_range] if request.time_range else []
    texts += [str(f.value) for f in request.filters if f.op.upper().strip() == "TEMPORAL_RANGE"]
    return tuple(resolve(t, now) for t in texts)


class ResultCache:
    """Parquet folders per key under the shared folder; a hit reads, a miss writes once.

    ``source`` must name the data itself (its path or table version), since equal
    requests over different data may not share an answer.  An answer is written
    to a folder of its own and counts once its mark of completion is there, so
    a write that died is never read and never in the way of the next.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_dir(spark)}/marlstone/results"
        self.hits = 0

    def answer(
        self, source: str, dataset: Dataset, request: Request, now: datetime, roles: tuple[str, ...] = ()
    ) -> DataFrame:
        key = request_key(f"{source}:{dataset.df.schema.json()}", request, roles, resolved_bounds(dataset, request, now))
        found = self._complete(key)
        if found is None:
            found = f"{self.folder}/{key}/{uuid.uuid4().hex}"
            compile_request(dataset, request, now).write.parquet(found)
        else:
            self.hits += 1
        return self.spark.read.parquet(found)

    def _complete(self, key: str) -> str | None:
        """A folder of the key that Spark's committer has marked as finished."""
        jvm = self.spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{key}")
        files = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        marks = files.globStatus(jvm.org.apache.hadoop.fs.Path(top, "*/_SUCCESS")) if files.exists(top) else None
        return marks[0].getPath().getParent().toString() if marks else None
