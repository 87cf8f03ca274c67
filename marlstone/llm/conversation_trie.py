"""The trie of the prefixes of conversations, rolled up by centroid decomposition.

``number`` puts the turns of every conversation in order, ``build`` makes one
node of every distinct sequence of first turns and adds up values over its
subtree.  A prefix is known by 128 bits, the exclusive or of hashes of (place,
turn): partial results of stretches of a long conversation join in any number
of tasks, so none has to fit in one.

The rollup takes parent edges apart at centroids.  The weight of a node is the
number of conversations that share it; what its subtree weighs comes with the
grouping of the rows.  In every component the centroid is the lowest node whose
subtree has more than half of the weight.  The total of that subtree is added
along the path from the centroid to the component's top, then the centroid is
taken out; what is left of its component and each subtree below it are
components with half the weight at most.  A value reaches an ancestor exactly
once: when the first centroid on the way between both is taken out.

Components too heavy for a task are split by joins, all of a round together:
there are at most as many as total weight over ``bound``.  The others are taken
apart in tasks, whole components at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, keep_on_disk, words_of

#: Weight (turns of all conversations) of a component that one task takes apart.
BOUND = 200_000
#: Conversation ids in a piece of a list of ids.
PIECE = 1 << 16

_ROOT = "named_struct('a', 0L, 'b', 0L)"
EMPTY = hashlib.sha256(b"").hexdigest()


# --- turns in order ----------------------------------------------------------


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of every row among those of its conversation in this task, from 1; rows come sorted."""
    chunk, last, done = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        here = np.arange(len(ids))
        first = np.maximum.accumulate(np.where(np.concatenate([[True], ids[1:] != ids[:-1]]), here, 0))
        place = here - first + 1
        if ids[0] == last:
            place[: int(np.searchsorted(first, 0, "right"))] += done
        last, done = ids[-1], int(place[-1])
        extra = [pa.array(np.full(len(ids), chunk, np.int32)), pa.array(place)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "chunk", "place"])


def number(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``chunk``, ``place`` (from 1), ``h1``, ``h2`` and ``words`` of every turn.

    Turns are in order of ``turn``, null first, ties by role and text; repeated
    rows are turns of their own.  Null roles and texts are empty.  Rows without
    a conversation belong to none and are left out.  Rows are dealt by ranges,
    so a long conversation is spread: ``chunk`` is the stretch that a row is in.
    Other columns are not read.
    """
    rows = turns.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    facts = rows.select("*", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(1), "role").alias("h2"), F.size(words_of(F.col("text"))).cast("long").alias("words"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = facts.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "h1", "h2", "words")
    placed = keep_on_disk(dealt.mapInArrow(_places, "conv_id bigint, h1 bigint, h2 bigint, words bigint, chunk int, place bigint"), "trie-turns")
    spans = placed.groupBy("conv_id", "chunk").agg(F.max("place").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    # Only the first conversation of a chunk can have begun in another: one row per chunk at most.
    carried = spans.select("conv_id", "chunk", before.alias("before")).where("before > 0")
    joined = placed.join(F.broadcast(carried), ["conv_id", "chunk"], "left")
    return joined.select("conv_id", "chunk", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "h1", "h2", "words")


def _prefixes(rows: DataFrame) -> DataFrame:
    """The rows with ``id``, the hash of all turns up to each, and ``parent``, that of the turns before."""
    own = rows.select("*", F.xxhash64("place", "h1", "h2").alias("c1"), F.xxhash64("h2", F.lit(2), "place", "h1").alias("c2"))
    stretch = Window.partitionBy("conv_id", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    local = own.select("conv_id", "chunk", "place", "length", "words", "c1", "c2", F.bit_xor("c1").over(stretch).alias("p1"), F.bit_xor("c2").over(stretch).alias("p2"))
    totals = own.groupBy("conv_id", "chunk").agg(F.bit_xor("c1").alias("t1"), F.bit_xor("c2").alias("t2"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # As above: one row per chunk at most.
    carried = totals.select("conv_id", "chunk", F.bit_xor("t1").over(earlier).alias("b1"), F.bit_xor("t2").over(earlier).alias("b2")).where("b1 IS NOT NULL")
    joined = local.join(F.broadcast(carried), ["conv_id", "chunk"], "left")
    p1, p2 = (F.col(f"p{k}").bitwiseXOR(F.coalesce(F.col(f"b{k}"), F.lit(0))) for k in (1, 2))
    whole = joined.select("conv_id", F.col("place").alias("depth"), "length", "words", "c1", "c2", p1.alias("p1"), p2.alias("p2"))
    up = F.struct(F.col("p1").bitwiseXOR(F.col("c1")).alias("a"), F.col("p2").bitwiseXOR(F.col("c2")).alias("b"))
    return whole.select("conv_id", "depth", "length", "words", F.struct(F.col("p1").alias("a"), F.col("p2").alias("b")).alias("id"), up.alias("parent"))


# --- centroids ---------------------------------------------------------------


def _preorder(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes in depth-first order, and where the subtree of each ends in it."""
    n = len(parent)
    by_parent = np.argsort(parent, kind="stable")
    firsts = np.searchsorted(parent[by_parent], np.arange(n + 1)).tolist()
    children = by_parent.tolist()
    order, end = [], [0] * n
    stack = children[: firsts[0]][::-1]
    while stack:
        v = stack.pop()
        if v < 0:  # all below this one are done
            end[~v] = len(order)
            continue
        order.append(v)
        stack.append(~v)
        stack += children[firsts[v] : firsts[v + 1]]
    return np.array(order, dtype=np.int64), np.array(end, dtype=np.int64)


def decompose(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (columns, nodes) over the subtrees of a forest, by centroid decomposition.

    ``parent`` is -1 at tops, ``weight`` is what a subtree weighs, more than
    those of its children together.  All components are split at once; there are
    as many rounds as the heaviest can be halved.
    """
    n = len(parent)
    order, end = _preorder(parent)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    up = np.where(parent[order] >= 0, place[parent[order]], -1)
    end, weight, values = end[order], weight[order].copy(), values[:, order]
    out = np.zeros_like(values)
    comp = np.maximum.accumulate(np.where(up < 0, np.arange(n), 0))
    total = weight.copy()  # of a component, at the place of its top
    alive = np.arange(n)
    while len(alive):
        alive = alive[np.argsort(comp[alive], kind="stable")]
        own = comp[alive]
        path = 2 * weight[alive] > total[own]
        # The nodes with more than half are the path from the top to the centroid, which comes last.
        centroid = np.full(n, -1)
        centroid[own[path]] = alive[path]
        c = centroid[own]
        below = (alive >= c) & (alive < end[c])
        subtotal = np.zeros((len(values), n), values.dtype)
        for k in range(len(values)):
            np.add.at(subtotal[k], own[below], values[k, alive[below]])
        out[:, alive[path]] += subtotal[:, own[path]]
        gone = weight[c]
        above = path & (alive != c)
        tops = np.flatnonzero(below & (up[alive] == c))
        weight[alive[above]] -= gone[above]
        here = alive == c
        total[own[here]] -= gone[here]
        total[alive[tops]] = weight[alive[tops]]
        mark = np.full(len(alive), -1)
        mark[tops] = tops
        new = np.maximum.accumulate(mark) if len(mark) else mark
        deeper = below & ~here
        comp[alive[deeper]] = alive[new[deeper]]
        alive = alive[~here]
    back = np.empty_like(out)
    back[:, order] = out
    return back


_VALUES = ("leaves", "saved")


def _in_tasks(bound: int):
    """Take whole components apart; rows come sorted by component, ``bound`` nodes of them or more at a time."""

    def solve(table: pa.Table) -> list[pa.RecordBatch]:
        n = table.num_rows
        pairs = [np.concatenate([table.column(f"{c}_{k}").to_numpy() for c in ("id", "parent")]) for k in "ab"]
        one, two = pd.factorize(pairs[0])[0], pd.factorize(pairs[1])[0]
        codes = pd.factorize(one * (int(two.max()) + 1) + two)[0]
        where = np.full(int(codes.max()) + 1, -1)
        where[codes[:n]] = np.arange(n)
        top = (table.column("top_a").to_numpy() == pairs[0][:n]) & (table.column("top_b").to_numpy() == pairs[1][:n])
        parent = np.where(top, -1, where[codes[n:]])
        sums = decompose(parent, table.column("weight").to_numpy(), np.stack([table.column(v).to_numpy() for v in _VALUES]))
        columns = [table.column("id_a"), table.column("id_b")]
        columns += [pa.array(table.column(f"sum_{v}").to_numpy() + sums[k]) for k, v in enumerate(_VALUES)]
        return pa.table(columns, names=["id_a", "id_b", *[f"sum_{v}" for v in _VALUES]]).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < bound:
                continue
            table = pa.Table.from_batches(held)
            a, b = table.column("top_a").to_numpy(), table.column("top_b").to_numpy()
            # The last component may go on in the next batch.
            other = np.flatnonzero((a != a[-1]) | (b != b[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from solve(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held and sum(b.num_rows for b in held):
            yield from solve(pa.Table.from_batches(held))

    return run


def _split(nodes: DataFrame, rows: DataFrame, bound: int) -> tuple[DataFrame, DataFrame]:
    """One round of heavy components: (centroids with their sums, all other nodes in their new components)."""
    path = 2 * F.col("weight") > F.col("total")
    # Heavier than ``bound`` each and disjoint: total weight over ``bound`` rows at most, here and below.
    lowest = F.min(F.struct("weight", "depth", "id")).alias("c")
    centroid = nodes.where(path).groupBy("top").agg(lowest).select("top", F.col("c.id").alias("c_id"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight"))
    through = rows.join(F.broadcast(centroid), rows["parent"] == centroid["c_id"]).select(centroid["top"], F.col("conv_id").alias("owner"), rows["id"].alias("child"))
    placed = nodes.join(F.broadcast(centroid), "top").join(through, ["top", "owner"], "left")
    placed = placed.withColumn("child", F.when(F.col("depth") > F.col("c_depth"), F.col("child"))).withColumn("here", F.col("id") == F.col("c_id")).withColumn("path", path)
    placed = keep_on_disk(placed, "trie-split")
    below = placed.where("here OR child IS NOT NULL").groupBy("top").agg(*[F.sum(v).alias(f"sub_{v}") for v in _VALUES])
    heavy = placed.where(F.col("id") == F.col("child")).where(F.col("weight") > bound).select(F.col("id").alias("child"), F.col("weight").alias("child_weight"))
    added = placed.join(F.broadcast(below), "top").join(F.broadcast(heavy), "child", "left")
    sums = {f"sum_{v}": F.col(f"sum_{v}") + F.when(F.col("path"), F.col(f"sub_{v}")).otherwise(0) for v in _VALUES}
    done = added.where("here").select("id", *[c.alias(n) for n, c in sums.items()])
    under = F.col("child").isNotNull()
    left = added.where("NOT here").select(
        "id", "parent", "owner", "depth",
        F.when(under | ~F.col("path"), F.col("weight")).otherwise(F.col("weight") - F.col("c_weight")).alias("weight"),
        *_VALUES,
        *[c.alias(n) for n, c in sums.items()],
        F.when(under, F.col("child")).otherwise(F.col("top")).alias("top"),
        # A component of unknown total is a light one.
        F.when(under, F.coalesce("child_weight", F.lit(0))).otherwise(F.col("total") - F.col("c_weight")).alias("total"),
    )
    out = keep_on_disk(done, "trie-centroids"), keep_on_disk(left, "trie-components")
    discard(placed)
    return out


def rollup(nodes: DataFrame, rows: DataFrame, bound: int = BOUND) -> DataFrame:
    """``id`` and the sums of ``leaves`` and ``saved`` over the subtree of every node.

    ``nodes`` has ``id``, ``parent``, ``owner`` (a conversation through the
    node), ``depth``, ``weight`` (of the subtree) and the values; ``rows`` the
    ``conv_id``, ``id`` and ``parent`` of every turn: a node is below a centroid
    if its owner goes through a child of it.
    """
    root = F.expr(_ROOT)
    total = nodes.agg(F.max("weight")).first()[0] or 0
    left = nodes.select("id", "parent", "owner", "depth", "weight", *_VALUES, *[F.lit(0).cast("long").alias(f"sum_{v}") for v in _VALUES], root.alias("top"), F.lit(total).alias("total"))
    parts, light, heavy = [], [], total > bound
    while heavy:
        done, now = _split(left, rows, bound)
        parts.append(done)
        light.append(now.where(F.col("total") <= bound))
        left = now.where(F.col("total") > bound)
        heavy = not left.isEmpty()
    small = reduce(DataFrame.unionByName, light) if light else left
    # The root has no parent, but then it is a top.
    flat = lambda c: [F.coalesce(F.col(f"{c}.{k}"), F.lit(0)).alias(f"{c}_{k}") for k in "ab"]
    sent = small.select(*flat("top"), *flat("id"), *flat("parent"), "weight", *_VALUES, *[f"sum_{v}" for v in _VALUES])
    sorted_ = sent.repartition("top_a", "top_b").sortWithinPartitions("top_a", "top_b")
    solved = sorted_.mapInArrow(_in_tasks(bound), "id_a bigint, id_b bigint, sum_leaves bigint, sum_saved bigint")
    parts.append(solved.select(F.struct(F.col("id_a").alias("a"), F.col("id_b").alias("b")).alias("id"), "sum_leaves", "sum_saved"))
    return reduce(DataFrame.unionByName, parts)


# --- the trie ----------------------------------------------------------------


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of every list, joined by commas; pieces come in order."""
    last, digest = None, None
    for batch in batches:
        found = []
        for a, b, piece in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "piece")), strict=True):
            if (a, b) != last:
                if last is not None:
                    found.append((*last, digest.hexdigest()))
                last, digest = (a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        yield _digest_rows(found)
    if last is not None:
        yield _digest_rows([(*last, digest.hexdigest())])


def _digest_rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    columns = [pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "ends_sha256"])


def _ends(rows: DataFrame) -> DataFrame:
    """Digest of the ids that end in a node (``id``, ``conv_id``).

    Ids are sorted and spelled out in pieces of ``PIECE`` possible ids; only
    the pieces of a node meet in a task, one after another, as a digest takes them.
    """
    pieces = rows.groupBy("id", F.floor(F.col("conv_id") / PIECE).alias("at")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    spelled = pieces.select(F.col("id.a").alias("a"), F.col("id.b").alias("b"), "at", F.array_join(F.col("ids").cast("array<string>"), ",").alias("piece"))
    sorted_ = spelled.repartition("a", "b").sortWithinPartitions("a", "b", "at").select("a", "b", "piece")
    return sorted_.mapInArrow(_digests, "a bigint, b bigint, ends_sha256 string").select(F.struct("a", "b").alias("id"), "ends_sha256")


def build(turns: DataFrame, conversations: DataFrame, bound: int = BOUND) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns`` are rows of ``number`` with the ``length`` of the conversation,
    places without gaps from 1 on; ``conversations`` has ``conv_id``, each once,
    and its ``length``, also of those without turns, which are members of the
    root.  Without conversations there is no node.

    ``conv_id`` is the smallest member, ``saved_tokens`` the words of last turns
    that members after the first repeat, added up over the subtree.
    """
    rows = keep_on_disk(_prefixes(turns), "trie-rows")
    ends: Column = F.max(F.when(F.col("depth") == F.col("length"), 1).otherwise(0)).alias("ended")
    weigh = F.sum(F.col("length") - F.col("depth") + 1).alias("weight")
    one = rows.groupBy("id").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("owner"), F.max("depth").alias("depth"), F.max("words").alias("words"), F.count(F.lit(1)).alias("n"), weigh, ends
    )
    none = F.lit(None).cast("struct<a:bigint,b:bigint>")
    top = conversations.agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n"), F.sum(F.col("length") + 1).alias("weight"), F.max(F.when(F.col("length") == 0, 1).otherwise(0)).alias("ended")
    ).where("n > 0")
    root = top.select(F.expr(_ROOT).alias("id"), none.alias("parent"), "owner", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "n", "weight", "ended")
    plain = keep_on_disk(one.unionByName(root), "trie-plain")
    children = plain.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = plain.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    valued = counted.select("*", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("words")).alias("saved"))
    nodes = keep_on_disk(valued, "trie-nodes")
    discard(plain)
    sums = rollup(nodes, rows.select("conv_id", "id", "parent"), bound)
    names = nodes.where("n_children > 0").select(F.col("id").alias("parent"), F.col("owner").alias("parent_conv_id"))
    turnless = conversations.where("length = 0").select(F.expr(_ROOT).alias("id"), "conv_id")
    ended = _ends(rows.where("depth = length").select("id", "conv_id").unionByName(turnless))
    whole = nodes.join(sums, "id").join(names, "parent", "left").join(ended, "id", "left")
    return whole.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.col("sum_leaves").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def lengths(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``length`` of every conversation that has a turn."""
    return turns.groupBy("conv_id").agg(F.max("place").alias("length"))


def trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", bound: int = BOUND) -> DataFrame:
    """The trie of the conversations as they are; nulls, ties and repeats as in ``number``, columns as in ``build``."""
    numbered = keep_on_disk(number(turns, conv, turn, role, text), "trie-numbered")
    sizes = lengths(numbered)
    return build(numbered.join(sizes, "conv_id"), sizes, bound)
