"""Small column and storage helpers of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.session import discard, materialise

__all__ = ["WORD", "WORD_GAP", "discard", "documents", "keep_on_disk", "let", "noting", "words_of"]

# Fixed by the contracts: what separates words.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column named in a lambda may be put in by the optimiser and computed
    again for each element; a lambda's own variable never is.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


_notes: list[list[DataFrame]] = []


def keep_on_disk(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage."""
    kept = materialise(df, label)
    for note in _notes:
        note.append(kept)
    return kept


@contextmanager
def noting() -> Iterator[list[DataFrame]]:
    """The list of what is kept on disk meanwhile, to be discarded when no reader is left."""
    note: list[DataFrame] = []
    _notes.append(note)
    try:
        yield note
    finally:
        _notes[:] = [n for n in _notes if n is not note]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")
