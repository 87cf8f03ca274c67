"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits of a fingerprint are grouped into a few partitions, correlated bits
together.  Two fingerprints within ``radius`` bits differ, in some partition i,
in at most t_i bits, for any thresholds from -1 (never) on whose sum of t_i + 1
is ``radius`` + 1.  Every fingerprint chooses its own: a dynamic programme over
the partitions takes the cheapest, by the lookups they cost and the candidates
they are expected to give.  So a value that a third of all fingerprints share
in one partition is passed by, and its neighbours are probed elsewhere.

Every fingerprint stands in the index under its value of each partition and
probes all values within its thresholds.  Candidates are verified on all bits.
Of a value that many share, not all pairs are tried: first everybody against
one head, then only what is still apart, in blocks.  No link that joins two
components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import keep_on_disk
from .grouping import components, spanning

BITS = 64
SEED = 42
#: A value of a partition is counted exactly if so large a part of all fingerprints has it; there are at most so many.
HEAVY = 1024
#: Candidates that cost as much as one lookup.
LOOKUP = 256
#: Fingerprints on each side of a block of candidates.
BLOCK = 512


# --- fingerprints ------------------------------------------------------------


def _prints(width: int):
    is_word, fold = tb.table(tb.BLANKS), tb.lower_ascii()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in tb.slices(batches, "text"):
            data, offsets = tb.buffers(batch.column("text"))
            starts, ends = tb.word_places(data, offsets, is_word)
            bounds = tb.per_text(starts, offsets)
            # All words one after another with a blank behind each; a shingle ends before the blank of its last.
            stops = np.cumsum(ends - starts + 1)
            begins = stops - (ends - starts + 1)
            joined = np.full(int(stops[-1]) if len(stops) else 0, ord(" "), dtype=np.uint8)
            letters = np.ones(len(joined), dtype=bool)
            letters[stops - 1] = False
            joined[letters] = fold[data[is_word[data]]]
            count = np.diff(bounds)
            made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
            edges = np.concatenate([[0], np.cumsum(made)])
            first = np.repeat(bounds[:-1], made) + np.arange(edges[-1]) - np.repeat(edges[:-1], made)
            last = first + np.repeat(np.minimum(count, width), made) - 1
            whole = joined.tobytes()
            spans = zip(begins[first].tolist(), (stops[last] - 1).tolist(), strict=True)
            hashes = np.fromiter((digest(whole[a:b], SEED) for a, b in spans), np.uint64, int(edges[-1]))
            prints = tb.simhash(hashes, edges)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (64 bits as a bigint) of each row.

    A-Z are lower-cased, words split at ASCII blanks, runs of ``width`` words
    joined by one blank hashed with XXH64, repeats included; with fewer words
    the whole sequence is the only run.  A bit is set if it is in over half of
    the hashes.  Without words (null, empty and blank texts) it is zero.
    """
    body = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return body.mapInArrow(_prints(width), "doc_id bigint, fingerprint bigint")


# --- partitions and thresholds ----------------------------------------------


@dataclass(frozen=True)
class Layout:
    """What all tasks know: the partitions, and statistics of all fingerprints."""

    size: int
    share: np.ndarray  # of fingerprints with the bit set, by bit
    parts: list[list[int]]
    heavy: list[tuple[np.ndarray, np.ndarray]]  # by partition: frequent values, sorted, and how many fingerprints have them


def _bits(prints: np.ndarray) -> np.ndarray:
    return ((prints[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often two bits are set together, for all pairs of bits."""
    both = np.zeros((BITS, BITS))
    for batch in batches:
        bits = _bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        both += bits.T @ bits
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(both.reshape(-1).astype(np.int64))], ["cell", "n"])


def correlated_parts(share: np.ndarray, together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of like size: each grown from one bit by those most correlated with it."""
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    tie = np.abs((together - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        left = sorted(free)
        own = [max(left, key=lambda b: (tie[b, left].sum(), -b))]
        free.discard(own[0])
        while len(own) < BITS // parts + (k < BITS % parts):
            own.append(max(sorted(free), key=lambda b: (tie[b, own].sum(), -b)))
            free.discard(own[-1])
        out.append(sorted(own))
    return out


def _number_of_parts(size: int, share: np.ndarray, radius: int) -> int:
    """The cheapest number of partitions if all bits were independent."""
    rare = -np.log2(np.maximum(share**2 + (1 - share) ** 2, 1e-12)).mean()

    def cost(parts: int) -> float:
        width = BITS // parts
        levels = [(radius + 1) // parts + (k < (radius + 1) % parts) for k in range(parts)]
        looked = [sum(comb(width, d) for d in range(n)) for n in levels]
        return sum(x * (LOOKUP + size * 2 ** (-rare * width)) for x in looked)

    return min(range(2, radius + 3), key=cost)


def _mask(part: list[int]) -> int:
    return sum(1 << b for b in part)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def layout(prints: DataFrame, radius: int) -> Layout:
    """Partitions and statistics from all of ``prints`` (column ``id``, each once).

    What reaches the driver is a matrix of 64 by 64 counts and, by partition, the
    values that one fingerprint of ``HEAVY`` has: ``HEAVY`` at most.
    """
    cells = prints.select("id").mapInArrow(_together, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    both = np.zeros(BITS * BITS)
    for row in cells.collect():
        both[row["cell"]] = row["n"]
    size = max(1, prints.count())
    both = both.reshape(BITS, BITS) / size
    share = np.diag(both).copy()
    parts = correlated_parts(share, both, _number_of_parts(size, share, radius))
    values = F.array(*[F.col("id").bitwiseAND(F.lit(_signed(_mask(p)))) for p in parts])
    counted = prints.select(F.posexplode(values).alias("part", "value")).groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    heavy = [([], []) for _ in parts]
    for part, value, n in sorted((r["part"], r["value"] % (1 << BITS), r["n"]) for r in counted.where(F.col("n") > max(1, size // HEAVY)).collect()):
        heavy[part][0].append(value)
        heavy[part][1].append(n)
    return Layout(size, share, parts, [(np.array(v, np.uint64), np.array(n, np.int64)) for v, n in heavy])


def thresholds(prints: np.ndarray, plan: Layout, radius: int) -> np.ndarray:
    """Of each fingerprint the thresholds with the least expected cost, (fingerprints, partitions).

    Frequent values are expected as often as they were counted, others as
    often as their bits are if these were independent; how many more lie around
    them follows from the odds of their bits.
    """
    bits = _bits(prints)
    own = np.clip(np.where(bits > 0, plan.share, 1 - plan.share), 1e-9, 1 - 1e-9)
    odds = (1 - own) / own
    budget = radius + 1
    cost = np.full((len(prints), len(plan.parts), budget + 1), np.inf)
    for i, part in enumerate(plan.parts):
        expected = plan.size * np.exp(np.log(own[:, part]).sum(axis=1))
        value = prints & np.uint64(_mask(part))
        values, counts = plan.heavy[i]
        if len(values):
            at = np.minimum(np.searchsorted(values, value), len(values) - 1)
            expected = np.where(values[at] == value, counts[at], expected)
        # Expected numbers at distance 0, 1, ...: elementary symmetric sums of the odds.
        around = np.zeros((len(prints), budget))
        around[:, 0] = 1
        for b in part:
            for d in range(budget - 1, 0, -1):
                around[:, d] += around[:, d - 1] * odds[:, b]
        cost[:, i, 0] = 0
        for t in range(budget):
            lookups = sum(comb(len(part), d) for d in range(t + 1))
            cost[:, i, t + 1] = np.minimum(expected * around[:, : t + 1].sum(axis=1), plan.size) + LOOKUP * lookups
    least = np.full((len(prints), budget + 1), np.inf)
    least[:, 0] = 0
    taken = []
    for i in range(len(plan.parts)):
        # options[:, s, k]: k of the budget for this partition, s in all.
        options = np.full((len(prints), budget + 1, budget + 1), np.inf)
        for s in range(budget + 1):
            for k in range(s + 1):
                options[:, s, k] = least[:, s - k] + cost[:, i, k]
        taken.append(options.argmin(axis=2))
        least = options.min(axis=2)
    out = np.zeros((len(prints), len(plan.parts)), dtype=np.int64)
    left = np.full(len(prints), budget)
    for i in range(len(plan.parts) - 1, -1, -1):
        k = taken[i][np.arange(len(prints)), left]
        out[:, i] = k - 1
        left -= k
    return out


def _keys(plan: Layout, radius: int):
    """Index rows and probes of fingerprints: ``key``, ``id``, ``asks`` (a probe) and ``stands`` (an index row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            limits = thresholds(prints, plan, radius)
            for i, part in enumerate(plan.parts):
                value, salt = prints & np.uint64(_mask(part)), np.uint64(i + 1)
                asks = limits[:, i] >= 0
                yield _rows(tb.mix(value + salt), prints, asks, np.ones(len(prints), bool))
                for d in range(1, int(limits[:, i].max(initial=-1)) + 1):
                    far = np.flatnonzero(limits[:, i] >= d)
                    for flips in combinations(part, d):
                        yes = np.ones(len(far), bool)
                        yield _rows(tb.mix((value[far] ^ np.uint64(_mask(list(flips)))) + salt), prints[far], yes, ~yes)

    return run


def _rows(key: np.ndarray, prints: np.ndarray, asks: np.ndarray, stands: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(key.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(asks), pa.array(stands)]
    return pa.RecordBatch.from_arrays(columns, ["key", "id", "asks", "stands"])


# --- links -------------------------------------------------------------------


def _near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def _links_in_block(radius: int):
    def run(block: pa.Table) -> pa.Table:
        side = block["left"].to_numpy()
        ids = block["id"].to_numpy()
        left, right = np.unique(ids[side]).view(np.uint64), np.unique(ids[~side]).view(np.uint64)
        near = np.bitwise_count(left[:, None] ^ right[None]) <= radius
        both = np.concatenate([left, right])
        link = np.zeros((len(both), len(both)), bool)
        link[: len(left), len(left) :] = near
        link |= link.T
        a, b = spanning(both.view(np.int64), link)
        return pa.table({"a": a, "b": b}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows ``group``, ``id``, ``left`` dealt so that every left row meets every right one of its group in some block."""
    cuts = lambda side: F.ceil(F.count(F.when(side, 1)) / BLOCK).cast("int")
    count = rows.groupBy("group").agg(cuts(F.col("left")).alias("__l"), cuts(~F.col("left")).alias("__r")).where("__l > 0 AND __r > 0")
    own = F.pmod(F.xxhash64("id"), F.when(F.col("left"), F.col("__l")).otherwise(F.col("__r"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("left"), F.col("__r")).otherwise(F.col("__l")) - 1))
    dealt = rows.join(count, "group").select("group", "id", "left", own.alias("__own"), other.alias("__other"))
    place = lambda a, b: F.when(F.col("left"), F.col(a)).otherwise(F.col(b))
    return dealt.select("group", "id", "left", place("__own", "__other").alias("i"), place("__other", "__own").alias("j"))


def linked(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``id`` and ``label`` (the smallest it is connected with) of the fingerprints that have links.

    ``prints`` has ``id``, each fingerprint once.
    """
    plan = layout(prints, radius)
    rows = prints.select("id").mapInArrow(_keys(plan, radius), "key bigint, id bigint, asks boolean, stands boolean")
    whose = F.bit_xor(F.xxhash64("id", "asks", "stands"))
    sized = rows.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.max("asks").alias("asked"), F.max("stands").alias("there"), whose.alias("set"))
    crowded = sized.where("a != b AND asked AND there").select("key", "set")
    # Keys with the same fingerprints in the same parts count once.
    members = keep_on_disk(rows.join(crowded, "key").select(F.col("set").alias("key"), "id", "asks", "stands").distinct(), "simhash-members")
    head = members.groupBy("key").agg(F.min(F.when(F.col("stands"), F.col("id"))).alias("head"))
    star = members.join(head, "key").where((F.col("id") != F.col("head")) & _near(F.col("id"), F.col("head"), radius))
    found = keep_on_disk(star.select(F.col("head").alias("a"), F.col("id").alias("b")).distinct(), "simhash-star")
    label = components(found)
    placed = members.join(label, "id", "left").select("key", "id", "asks", "stands", F.coalesce("label", "id").alias("comp"))
    counted = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("key").agg(F.max(F.struct("n", "comp")).getField("comp").alias("most"), F.count(F.lit(1)).alias("comps"), F.sum("n").alias("n"))
    # With two fingerprints in a key, the star has tried the only pair.
    still = placed.join(largest.where("comps > 1 AND n > 2").select("key", "most"), "key").withColumn("out", F.col("comp") != F.col("most"))
    # Whoever asks from outside the largest component meets all; whoever is in it meets those outside.
    sides = F.array(
        F.when(F.col("asks") & F.col("out"), F.struct(F.lit(1).alias("turn"), F.lit(True).alias("left"))),
        F.when(F.col("stands"), F.struct(F.lit(1).alias("turn"), F.lit(False).alias("left"))),
        F.when(F.col("asks") & ~F.col("out"), F.struct(F.lit(2).alias("turn"), F.lit(True).alias("left"))),
        F.when(F.col("stands") & F.col("out"), F.struct(F.lit(2).alias("turn"), F.lit(False).alias("left"))),
    )
    sided = still.select("key", "id", F.explode(F.array_compact(sides)).alias("s")).select(F.struct("key", "s.turn").alias("group"), "id", "s.left")
    open_rows = keep_on_disk(sided, "simhash-open")
    if open_rows.isEmpty():
        return label
    more = _in_blocks(open_rows).groupBy("group", "i", "j").applyInArrow(_links_in_block(radius), "a bigint, b bigint")
    return components(found.union(more))


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of each row.

    Fingerprints that differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest id that links reach, itself included.

    Texts without words (null, empty, blank) have the fingerprint zero and are
    linked like others.  Rows that share an id are not linked by that.  Rows
    without an id take part; their component has the smallest id it reaches,
    null if there is none.  Only ``id`` and ``text`` are read, so other columns
    may have any name.
    """
    prints = keep_on_disk(fingerprints(docs, id, text, width), "simhash-prints")
    classes = keep_on_disk(prints.groupBy(F.col("fingerprint").alias("id")).agg(F.min("doc_id").alias("least")), "simhash-classes")
    labelled = classes.join(linked(classes, radius), "id", "left").select("id", F.coalesce("label", "id").alias("label"), "least")
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = labelled.join(smallest, "label").select(F.col("id").alias("fingerprint"), "component_id")
    return prints.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")
