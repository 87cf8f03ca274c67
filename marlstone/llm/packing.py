"""Best-fit packing under conflicts.

Documents go into bins of a fixed capacity so that no bin holds two of one
source or two of one cluster of duplicates.  Lengths of more than a bin are
cut: whole bins stand alone, the rest is packed.  Items are dealt into shards
of about ``shard`` items by a hash, and each shard is packed by itself, longest
first: its bins are kept in the order of what is left in them, each with a
bitmap of its sources and clusters; from the tightest bin that is large enough
the search goes on to the next until the bitmaps have nothing in common.  Only
if no bin will do, a new one is opened.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_on_disk

CAPACITY, SHARD = 2048, 8192


def best_fit(lengths: list[int], masks: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and place in the bin of each item; items come longest first, none longer than ``capacity``.

    Items whose ``masks`` share a bit are never put together.
    """
    left: list[int] = []  # what is left in the open bins, ascending
    at: list[int] = []  # and which bins these are
    bitmap: list[int] = []
    out = []
    for length, mask in zip(lengths, masks, strict=True):
        i = bisect_left(left, length)
        while i < len(at) and bitmap[at[i]] & mask:
            i += 1
        if i < len(at):
            room, own = left.pop(i), at.pop(i)
        else:
            room, own = capacity, len(bitmap)
            bitmap.append(0)
        bitmap[own] |= mask
        out.append((own, capacity - room))
        rest = room - length
        k = bisect_left(left, rest)
        left.insert(k, rest)
        at.insert(k, own)
    return out


def _bits(values: list) -> list[int]:
    """One bit per value that occurs twice or more; others and nulls conflict with nothing."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    place = {v: i for i, v in enumerate(v for v, n in seen.items() if n > 1 and v is not None)}
    return [1 << place[v] if v in place else 0 for v in values]


def _pack_shard(capacity: int):
    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("length", "descending"), ("doc_id", "ascending"), ("cluster", "ascending"), ("copy", "ascending")])
        source, cluster = _bits(shard["source"].to_pylist()), _bits(shard["cluster"].to_pylist())
        width = max((m.bit_length() for m in source), default=0)
        placed = best_fit(shard["length"].to_pylist(), [a | b << width for a, b in zip(source, cluster, strict=True)], capacity)
        names = pa.array([f"{s}:{b}" for s, (b, _) in zip(shard["shard"].to_pylist(), placed, strict=True)], pa.string())
        return shard.append_column("bin_id", names).append_column("position", pa.array([p for _, p in placed], pa.int64()))

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``bin_id``, ``position``, ``doc_id``, ``copy``, ``piece``, ``start``, ``length``, ``source``, ``cluster`` of every piece.

    ``items`` has ``doc_id``, ``length``, ``source`` and ``cluster``.  A null
    length counts as 0; pieces of length 0 take a place in a bin as well.
    Null sources and clusters conflict with nothing.  Equal rows are counted
    first and told apart by ``copy``, so a row that comes very often is spread
    over the shards.  ``start`` is where a piece begins in its document.
    """
    whole = items.select("doc_id", F.coalesce(F.col("length").cast("long"), F.lit(0).cast("long")).alias("length"), F.col("source").cast("string").alias("source"), F.col("cluster").cast("string").alias("cluster"))
    counted = whole.groupBy("doc_id", "length", "source", "cluster").agg(F.count(F.lit(1)).alias("n"))
    single = keep_on_disk(counted.select("doc_id", "length", "source", "cluster", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")), "items")
    full = F.floor(F.col("length") / capacity)
    shards = max(1, -(-single.count() // shard))
    rest = single.where((F.col("length") % capacity > 0) | (F.col("length") == 0)).select(
        "doc_id", "copy", full.alias("piece"), (full * capacity).alias("start"), (F.col("length") % capacity).alias("length"), "source", "cluster",
        F.pmod(F.xxhash64("doc_id", "copy", "cluster"), F.lit(shards)).alias("shard"),
    )
    kind = dict(rest.dtypes)["doc_id"]
    schema = f"doc_id {kind}, copy bigint, piece bigint, start bigint, length bigint, source string, cluster string, shard bigint, bin_id string, position bigint"
    packed = rest.groupBy("shard").applyInArrow(_pack_shard(capacity), schema)
    columns = ["bin_id", "position", "doc_id", "copy", "piece", "start", "length", "source", "cluster"]
    alone = single.where(full > 0).select(
        "doc_id", "copy", "source", "cluster", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)).alias("piece"), F.lit(0).cast("long").alias("position"), F.lit(capacity).cast("long").alias("length")
    )
    alone = alone.select("*", (F.col("piece") * capacity).alias("start"), F.concat_ws(":", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("cluster", F.lit("")), F.col("copy").cast("string"), F.col("piece").cast("string")).alias("bin_id"))
    return packed.select(*columns).union(alone.select(*columns))
