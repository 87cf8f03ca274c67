"""Token counts by a two-tier lookup on the map side.

A first pass lets every task sum up its commonest pre-tokens; the commonest of
all, with their lengths in tokens, are broadcast as one compact table.  Counting
then looks pre-tokens up there; what is missing is encoded by the library once
per worker and kept in the worker's cache.  No pre-token is shuffled, only the
tasks' summaries of bounded size are.  The table only saves time: any table
gives the same counts.

Texts in Latin script are cut here (lower case and the vocabulary's pattern);
texts with other letters, or with one of the special strings, go to the library
whole.  Pre-tokens never reach over one another, so their lengths add up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Pre-tokens in the broadcast table (under 2 MB), in a task's summary, and in a worker's cache.
TABLE, SUMMARY, CACHE = 1 << 15, 1 << 14, 1 << 20
_LONGEST = 64  # characters of a pre-token that the table may hold

_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
# Fixed by the vocabulary: how it cuts lower-cased text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\x09-\x0d\x20\x85\xa0\p{L}\p{N}]+")
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d\x20a-z0-9]+")


@cache
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@cache
def _special(path: str) -> re.Pattern:
    return re.compile("|".join(re.escape(t.content) for t in library(path).get_added_tokens_decoder().values()) or r"(?!)")


def pieces(text: str, path: str) -> list[str] | None:
    """Pre-tokens of a text, or None if the library has to see it whole."""
    if _special(path).search(text):
        return None
    if text.isascii():
        return _ASCII_PIECES.findall(text.lower())
    return None if _BEYOND_LATIN.search(text) else PIECES.findall(text.lower())


class _Lengths(dict):
    """Pre-token lengths: the broadcast table below, this worker's finds on top."""

    def __init__(self, path: str, table: dict[str, int]):
        super().__init__()
        self.library, self.table = library(path), table

    def __missing__(self, piece: str) -> int:
        found = self.table.get(piece)
        if found is None:
            found = len(self.library.encode(piece, add_special_tokens=False).ids)
        if len(self) >= CACHE:
            self.clear()
        if len(piece) <= _LONGEST:
            self[piece] = found
        return found


_worker: dict[tuple[str, int], _Lengths] = {}


def _texts(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[list[str]]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield [t or "" for t in batch.column("text").slice(at, step).to_pylist()]


def _summariser(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for texts in _texts(batches):
            for text in texts:
                seen.update(pieces(text, path) or ())
            if len(seen) > 16 * SUMMARY:
                seen = Counter(dict(seen.most_common(4 * SUMMARY)))
        top = [(w, n) for w, n in seen.most_common(SUMMARY) if len(w) <= _LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    return run


def frequent(docs: DataFrame, path: str, text: str = "text", size: int = TABLE) -> dict[str, int]:
    """Lengths in tokens of about the ``size`` commonest pre-tokens of all texts."""
    summaries = docs.select(F.col(text).alias("text")).mapInArrow(_summariser(path), "piece string, n bigint")
    top = summaries.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)
    words = [row["piece"] for row in top.collect()]
    found = library(path).encode_batch_fast(words, add_special_tokens=False)
    return {w: len(e.ids) for w, e in zip(words, found, strict=True)}


def _counter(path: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = path, shared.value[0]
        if key not in _worker:
            # A worker keeps one table: that of the job before is of no more use.
            _worker.clear()
            _worker[key] = _Lengths(path, shared.value[1])
        mine = _worker[key]
        for whole in batches:
            counts = []
            for texts in _texts([whole]):
                for text in texts:
                    cut = pieces(text, path)
                    if cut is None:
                        counts.append(len(mine.library.encode(text, add_special_tokens=False).ids))
                    else:
                        counts.append(sum(map(mine.__getitem__, cut)))
            yield pa.RecordBatch.from_arrays([whole.column("doc_id"), whole.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def count(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", table: dict[str, int] | None = None) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of each row.

    Counts are those of the library for the whole text without added special
    tokens.  Null texts count as empty.  Only ``id`` and ``text`` are read, so
    other columns may have any name.
    """
    context = docs.sparkSession.sparkContext
    table = frequent(docs, path, text) if table is None else table
    shared = context.broadcast((hash(frozenset(table.items())), table))
    body = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    body = body.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    return body.mapInArrow(_counter(path, shared), f"doc_id {dict(body.dtypes)['doc_id']}, n_bytes bigint, n_tokens bigint")
