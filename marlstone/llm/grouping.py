"""Groups of near-equal items: verified links inside buckets, then connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, keep_on_disk


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``label`` (the smallest id it is connected with) of every id in edges ``a``, ``b``.

    Alternating stars: every vertex links its larger neighbours to the
    smallest neighbour it knows, then the smaller ones, until all links point
    at roots.  The number of rounds grows with the logarithm of the diameter;
    links that are stars from the start need none.  Each round is written to
    the shared folder, so a lost executor costs a stage at most.
    """
    links = keep_on_disk(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _are_stars(links):
        before, links = links, keep_on_disk(_star(_star(links, larger=True), larger=False), "links")
        discard(before)
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("label")).union(roots)


def _are_stars(links: DataFrame) -> bool:
    """Whether every larger end has one link and no smaller end has one itself."""
    end = lambda c, up: links.select(F.col(c).alias("id"), F.lit(up).alias("up"), F.lit(1 - up).alias("root"))
    uses = end("u", 1).union(end("v", 0)).groupBy("id").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return uses.where("up > 1 OR (up = 1 AND root = 1)").isEmpty()


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One half round over links ``u > v``; the result has ``u > v`` again."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else links
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if larger:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.union(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def spanning(ids: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``ids`` that connect what the matrix of links connects, one less than members of each group."""
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label, np.where(link, label[None], len(ids)).min(axis=1, initial=len(ids)))
        if (least == label).all():
            break
        label = least
    far = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[far]], ids[far]


def crowded(buckets: DataFrame) -> DataFrame:
    """Rows of keys that hold more than one id, keys with the same ids only once.

    ``buckets`` has ``key`` and ``id``, each pair once; other columns belong to
    the id.  In the result the key stands for the set of its ids.
    """
    sets = F.bit_xor(F.xxhash64("id")).alias("__set")
    full = buckets.groupBy("key").agg(F.min("id").alias("__a"), F.max("id").alias("__b"), sets).where(F.col("__a") != F.col("__b")).select("key", "__set")
    return buckets.join(full, "key").drop("key").withColumnRenamed("__set", "key").distinct()


def linked(members: DataFrame, test: Callable[[DataFrame], DataFrame], by_degree: bool = True, rest: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Component labels from the verified links between ids that share a key.

    ``members`` has ``key``, ``id`` and ``sig`` (what the test needs of an id),
    each key and id once.  ``test`` is given rows ``group``, ``id``, ``sig``,
    ``asks`` and must find, in each group, all links of the ids that ask, among
    themselves and with those that do not; it returns pairs ``a``, ``b`` that
    connect what these links connect.  ``rest`` does the same for what is left
    after the heads, where most ids of a key may ask; without it ``test`` does.

    Not all pairs of a key are tried.  First every id is tried against one head
    of its key, the id that shares most keys with others (without
    ``by_degree``: the smallest); that settles a group of copies in as many
    trials as it has members.  Then only keys that still
    hold several components are looked at, and there the ids outside the
    largest component ask.  No link that would join two components is missed.
    """
    if by_degree:
        size = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        degree = members.join(size, "key").groupBy("id").agg(F.sum("n").alias("degree"))
        head = members.join(degree, "id").groupBy("key").agg(F.max(F.struct("degree", "id", "sig")).alias("head"))
    else:
        head = members.groupBy("key").agg(F.min(F.struct("id", "sig")).alias("head"))
    star = members.join(head, "key").where(F.col("id") != F.col("head.id")).select(F.col("head.id").alias("group"), "id", "sig", F.lit(False).alias("asks")).distinct()
    heads = head.select(F.col("head.id").alias("group"), "head.id", "head.sig", F.lit(True).alias("asks")).distinct()
    found = keep_on_disk(test(keep_on_disk(star.union(heads), "star")), "found")
    label = components(found)
    placed = members.join(label, "id", "left").select("key", "id", "sig", F.coalesce("label", "id").alias("comp"))
    counted = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("key").agg(F.max(F.struct("n", "comp")).getField("comp").alias("group"), F.count(F.lit(1)).alias("comps"), F.sum("n").alias("n"))
    # With two ids in a key, the star has tried the only pair.
    still = placed.join(largest.where("comps > 1 AND n > 2").select("key", "group"), "key")
    rows = keep_on_disk(still.select("group", "id", "sig", (F.col("comp") != F.col("group")).alias("asks")).distinct(), "open")
    if rows.isEmpty():
        return label
    return components(found.union((rest or test)(rows)))


def in_blocks(rows: DataFrame, most: int, weight: int, extra: tuple[str, ...] = (), wide: int = 1) -> DataFrame:
    """Deal the ids of each group into blocks that together hold every pair with an id that asks.

    ``rows`` has ``group``, ``id``, ``asks`` and ``sig``, its size; the result
    has ``block`` instead of the size, and the columns ``extra``.  An id goes to as many blocks as there are stretches of ``most``
    ids (or of a total size of ``weight``) on the other side, so what one task
    holds is bounded whatever the size of a group.  With ``wide`` stretches
    grow with the root of the group, to so many times that size at most, so
    an id goes to fewer blocks.
    """
    full = lambda side: F.greatest(F.count(F.when(side, 1)) / most, F.coalesce(F.sum(F.when(side, F.col("sig"))), F.lit(0)) / weight)
    cuts = lambda side: F.ceil(F.greatest(F.sqrt(full(side)), full(side) / wide)).cast("int")
    count = rows.groupBy("group").agg(cuts(F.col("asks")).alias("__a"), cuts(~F.col("asks")).alias("__b"), F.count(F.when(F.col("asks"), 1)).alias("__n"))
    dealt = rows.join(count, "group").withColumn("__own", F.pmod(F.xxhash64("id"), F.when(F.col("asks"), F.col("__a")).otherwise(F.col("__b"))).cast("int"))
    upto = lambda n: F.filter(F.sequence(F.lit(0), n), lambda k: k < n)
    block = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    own = F.col("__own")
    across = F.transform(upto(F.col("__b")), lambda k: block("across", own, k))
    among = F.transform(upto(F.col("__a")), lambda k: block("among", F.least(own, k), F.greatest(own, k)))
    answers = F.transform(upto(F.col("__a")), lambda k: block("across", k, own))
    # One id that asks alone, as in a star, has nobody to be tried against on its own side.
    asked = F.when(F.col("__n") > 1, F.concat(across, among)).otherwise(across)
    return dealt.select("group", "id", "asks", *extra, F.explode(F.when(F.col("asks"), asked).otherwise(answers)).alias("block"))


def by_block(rows: DataFrame, work: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``work`` on the blocks of ``in_blocks``, many small ones at a time.

    It is given whole blocks one after another and the places at which they
    begin (and the last ends).  What is held is one block and a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table, part: np.ndarray) -> Iterator[pa.RecordBatch]:
            begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            yield from work(table, np.append(begins, len(part))).to_batches()

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            part = table["__part"].to_numpy()
            other = np.flatnonzero(part != part[-1]) if len(part) else []
            if len(other):
                cut = int(other[-1]) + 1
                yield from solve(table.slice(0, cut), part[:cut])
                table = table.slice(cut)
            held = table.to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from solve(table, table["__part"].to_numpy())

    # Blocks are told apart by 64 bits of their names; two that agree are one, with more pairs than needed.
    named = rows.withColumn("__part", F.xxhash64("group", "block")).drop("block")
    return named.repartition("__part").sortWithinPartitions("__part").mapInArrow(run, schema)
