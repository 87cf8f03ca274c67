"""MinHash near-duplicates with two permutations (circulant MinHash).

Shingles are hashed into 32 bits and permuted once.  The second permutation,
its input shifted by k around the circle of 2^32, gives coordinate k of the
signature: one pair of permutations makes all coordinates.  Signatures are cut
into bands; texts that agree in a band are candidates; a pair is a link only
if the Jaccard similarity of the full shingle sets reaches the threshold.

Texts with the same words are one class from the start, so copies are never
paired.  With 16 bands of 4 rows a pair of similarity 0.8 goes unnoticed with
probability (1 - 0.8^4)^16, about 2 in 10,000.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import keep_on_disk
from .grouping import crowded, in_blocks, linked, spanning

#: Shingles worked on at a time; fits the processor's cache.
_STEP = 1 << 15
_SHIFT = 0x9E3779B1  # by which the circle is turned per coordinate
#: A block of texts to be compared: texts of one side, and their shingles.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 1 << 20
_COLUMNS = 4096
#: Bits of the sieve that texts pass before they are shuffled; two megabytes.
MARKS = 1 << 24


def _permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A fixed permutation of the 32-bit values, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signatures(shingles: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash of each text, (texts, size); texts without shingles keep the largest value."""
    out = np.full((size, len(bounds) - 1), 0xFFFFFFFF, dtype=np.uint32)
    text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for at in range(0, len(shingles), _STEP):
        first = _permute((shingles[at : at + _STEP] >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
        texts = text_of[at : at + _STEP]
        starts = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
        own = texts[starts]
        for k in range(size):
            turned = _permute(first + np.uint32(k * _SHIFT & 0xFFFFFFFF), 0x21F0AAAD, 0x735A2D97)
            out[k, own] = np.minimum(out[k, own], np.minimum.reduceat(turned, starts))
    return out.T


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band, (texts, bands)."""
    texts, size = signature.shape
    bands = signature.reshape(texts, size // rows, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(size // rows, dtype=np.uint64) + np.uint64(1), bands.shape[:2]).copy()
    for r in range(rows):
        key = tb.mix(key * np.uint64(0x9FB21C651E98DF25) + bands[:, :, r])
    return key.view(np.int64)


def _word_batches(batches: Iterator[pa.RecordBatch], width: int):
    is_word, fold = tb.table(tb.BLANKS), tb.lower_ascii()
    for batch in tb.slices(batches, "text"):
        data, offsets = tb.buffers(batch.column("text"))
        starts, _, hashes = tb.word_hashes(data, offsets, is_word, fold)
        bounds = tb.per_text(starts, offsets)
        one, two = tb.sequence_hashes(hashes, bounds)
        made, made_bounds = tb.shingles(hashes, bounds, width)
        yield batch, one.view(np.int64), two.view(np.int64), made, made_bounds


def _distinct(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, and their offsets."""
    sets = [np.unique(shingles[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def _links_in_block(percent: int):
    """Links between the texts of one block, as pairs that connect the same texts."""

    def run(block: pa.Table) -> pa.Table:
        ids, asks = block["id"].to_numpy(), block["asks"].to_numpy()
        lists = block["members"].combine_chunks()
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        text_of = np.repeat(np.arange(len(ids)), sizes)
        values, place, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        # Shingles of one text only have no part in any intersection.
        column = np.cumsum(times > 1) - 1
        kept = np.flatnonzero((times > 1)[place])
        kept = kept[np.argsort(column[place[kept]], kind="stable")]
        rows, columns = text_of[kept], column[place[kept]]
        common = np.zeros((len(ids), len(ids)))
        for at in range(0, int((times > 1).sum()), _COLUMNS):
            lo, hi = np.searchsorted(columns, [at, at + _COLUMNS])
            part = np.zeros((len(ids), _COLUMNS), dtype=np.float32)
            part[rows[lo:hi], columns[lo:hi] - at] = 1
            common += part @ part.T
        union = sizes[:, None] + sizes[None] - common
        link = (100 * common >= percent * union) & (asks[:, None] | asks[None])
        a, b = spanning(ids, link)
        return pa.table({"a": a, "b": b}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def _sketcher(width: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, one, two, made, bounds in _word_batches(batches, width):
            made, bounds = _distinct(made, bounds)
            keys = band_keys(signatures(made, bounds, rows * bands), rows)
            sizes = np.diff(bounds)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(one), pa.array(two), pa.array(sizes), lists], ["doc_id", "one", "two", "n_shingles", "bands"])

    return run


def _shingle_sets(width: int):
    """Sets of the texts whose words are those asked for (``own_one``, ``own_two``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, one, two, made, bounds in _word_batches(batches, width):
            asked = (batch.column("own_one").to_numpy() == one) & (batch.column("own_two").to_numpy() == two)
            made, bounds = _distinct(made, bounds)
            sets = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(made.view(np.int64))).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("many"), sets], ["id", "many", "members"]).filter(pa.array(asked))

    return run


def _marks(ids: np.ndarray) -> np.ndarray:
    return (tb.mix(ids.view(np.uint64)) & np.uint64(MARKS - 1)).astype(np.int64)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of ids, 64 in a row."""
    marks = np.zeros(MARKS, dtype=bool)
    for batch in batches:
        marks[_marks(batch.column(0).to_numpy(zero_copy_only=False))] = True
    packed = np.packbits(marks, bitorder="little").view(np.int64)
    used = np.flatnonzero(packed)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(packed[used])], ["at", "bits"])


def _perhaps(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` may be among ``wanted``: a sieve of ``MARKS`` bits, so that few texts are shuffled.

    The sieve has one size whatever the number of ids; beyond some ten million
    it lets nearly everything through, which the join that follows sorts out.
    """
    found = wanted.mapInArrow(_marked, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    packed = np.zeros(MARKS // 64, dtype=np.int64)
    packed[found["at"].to_numpy()] = found["bits"].to_numpy()
    sieve = packed.view(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _marks(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array((sieve[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    return docs.mapInArrow(run, docs.schema)


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, rows: int = 4, bands: int = 16) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each row.

    Words are split at ASCII blanks, A-Z lower-cased.  A pair is linked if 100
    times the intersection of its shingle sets is at least ``percent`` times
    their union.  ``component_id`` is the smallest id that links reach,
    ``kept`` whether that is the document itself.

    Null and empty texts have no shingles and are linked with nothing.  Rows
    with one id are one document: the words that sort first count for all.
    Rows without an id stay alone: no component, kept.  Only ``id`` and
    ``text`` are read, so other columns may have any name.
    """
    body = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id bigint, one bigint, two bigint, n_shingles bigint, bands array<bigint>"
    sketch = keep_on_disk(body.mapInArrow(_sketcher(width, rows, bands), schema), "sketch")
    ids = sketch.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("one", "two", "n_shingles")).alias("s"), (F.count(F.lit(1)) > 1).alias("many"))
    ids = ids.select("doc_id", "s.*", "many")
    classes = ids.where("n_shingles > 0").groupBy("one", "two").agg(F.min(F.struct("doc_id", "many")).alias("least"))
    classes = keep_on_disk(classes.select("one", "two", F.col("least.doc_id").alias("id"), "least.many"), "classes")
    heads = classes.select(F.col("id").alias("doc_id"), "one", "two")
    buckets = (
        sketch.join(heads, ["doc_id", "one", "two"], "left_semi")
        .dropDuplicates(["doc_id"])
        .select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("sig"))
    )
    members = keep_on_disk(crowded(buckets), "members")
    wanted = classes.select(F.col("id").alias("doc_id"), F.col("one").alias("own_one"), F.col("two").alias("own_two"), "many").join(
        members.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"
    )
    found = _perhaps(body, wanted.select("doc_id")).join(wanted, "doc_id").mapInArrow(_shingle_sets(width), "id bigint, many boolean, members array<bigint>")
    kept = keep_on_disk(found, "sets")
    # Only an id that comes more than once can have its set twice.
    sets = kept.where("NOT many").select("id", "members").union(kept.where("many").select("id", "members").dropDuplicates(["id"]))

    def test(rows: DataFrame) -> DataFrame:
        blocks = in_blocks(rows, BLOCK_TEXTS, BLOCK_SHINGLES).join(sets, "id")
        return blocks.groupBy("group", "block").applyInArrow(_links_in_block(percent), "a bigint, b bigint")

    label = linked(members, test)
    placed = classes.join(label, "id", "left").select("one", "two", F.coalesce("label", "id").alias("component_id"))
    by_id = ids.join(placed, ["one", "two"], "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    rows_out = sketch.select("doc_id", F.col("n_shingles").alias("__own")).join(by_id, "doc_id", "left")
    return rows_out.select(
        "doc_id",
        F.coalesce("n_shingles", "__own").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def thin(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, rows: int = 4, bands: int = 16) -> DataFrame:
    """The rows without near-duplicates: of every component the row with the smallest id.

    Of rows that share an id one stays; rows without an id all do.  Columns
    are passed on as they are.
    """
    found = keep_on_disk(groups(docs, id, text, width, percent, rows, bands), "groups")
    dropped = found.where("NOT kept").select(F.col("doc_id").alias("__id")).distinct()
    shared = found.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__id")
    same = docs[id].cast("long") == F.col("__id")
    # Ids that come more than once are rare; only their rows are compared with one another.
    single = docs.join(dropped.union(shared), same, "left_anti")
    return single.unionByName(docs.join(shared, same, "left_semi").dropDuplicates([id]))
