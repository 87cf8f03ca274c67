"""Graph jobs on two DataFrames: vertices ``id`` and edges ``src, dst``.

Iterations write their state to the shared folder, so plans stay short and a
lost executor costs one step.  Joins that follow edges out of a vertex are
salted by the other end where the vertex has very many: a vertex with a third
of all edges is spread over ``SALTS`` tasks, the others are not repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise
from .ordered import null_safe_join

SALTS = 8
#: Rows of one key from which on they are salted.
HOT_ROWS = 200_000
#: Edges contracted at once within a part, and edges in which triangles are looked for at once.
LOCAL_EDGES, TRIANGLE_EDGES = 1_000_000, 2_000_000


def salt_of(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")


def rows_per(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))


def hot_keys(counted: DataFrame, key: str) -> list:
    """Keys of more than ``HOT_ROWS`` rows by the count ``__n``: few, as each stands for so many rows."""
    return [r[0] for r in counted.filter((F.col("__n") > HOT_ROWS) & F.col(key).isNotNull()).select(key).collect()]


def salted(many: DataFrame, key: str, other: str, hot: list) -> DataFrame:
    """A column ``salt``: by ``other`` for rows of hot keys, 0 for all others."""
    return many.withColumn("salt", F.when(F.col(key).isin(hot), salt_of(F.col(other))).otherwise(F.lit(0)))


def per_salt(few: DataFrame, key: str, hot: list) -> DataFrame:
    """A column ``salt``: one copy of every row of a hot key per salt, the others once."""
    every = F.array(*[F.lit(i) for i in range(SALTS)])
    return few.withColumn("salt", F.explode(F.when(F.col(key).isin(hot), every).otherwise(F.array(F.lit(0)))))


def spread_join(many: DataFrame, few: DataFrame, key: str, other: str, how: str = "inner", hot: list | None = None) -> DataFrame:
    """Join on ``key`` where ``many`` may hold very many rows of one key.

    Rows of the ``hot`` keys (counted when not given) are salted by ``other``;
    the rows of ``few`` are repeated per salt for these keys alone.
    """
    hot = hot_keys(rows_per(many, key), key) if hot is None else hot
    if not hot:
        return many.join(few, key, how)
    return salted(many, key, other, hot).join(per_salt(few, key, hot), [key, "salt"], how).drop("salt")


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))


def pagerank(
    edges: DataFrame,
    iterations: int | None = 10,
    tolerance: float | None = None,
    keep_all: bool = False,
    damping: float = 0.85,
    max_iterations: int | None = None,
) -> DataFrame:
    """Rank per vertex after a number of rounds, or until no rank moves by more than ``tolerance``.

    Ranks start at 1 where links go out.  A vertex nobody links to leaves after
    the first round; with ``keep_all`` it stays with the base rank.  With a
    tolerance the rounds go on until it is kept; a given ``max_iterations``
    that does not suffice is an error.
    """
    edges = materialise(edges.select("src", "dst"), "edges")
    degrees = materialise(out_degrees(edges).withColumnRenamed("id", "src"), "degrees")
    hot = hot_keys(degrees.withColumnRenamed("degree", "__n"), "src")
    weighted = spread_join(edges, degrees, "src", "dst", hot=hot).select("src", "dst", (F.lit(1.0) / F.col("degree")).alias("part"))
    links = materialise(salted(weighted, "src", "dst", hot), "links")
    vertices = materialise(links.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), "vertices")
    begin = vertices if keep_all else links.select(F.col("src").alias("id")).distinct()
    ranks = materialise(begin.withColumn("rank", F.lit(1.0)), "rank-start")
    if tolerance is None and iterations is None:
        raise ValueError("give a number of iterations or a tolerance")
    for i in count():
        if tolerance is None and i == iterations:
            return ranks
        if tolerance is not None and i == max_iterations:
            raise RuntimeError(f"ranks have not settled in {max_iterations} rounds")
        copies = per_salt(ranks, "id", hot).withColumnRenamed("salt", "__salt")
        sent = links.join(copies, (F.col("src") == F.col("id")) & (F.col("salt") == F.col("__salt")))
        summed = sent.groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("part")).alias("got"))
        base = F.lit(1 - damping)
        if keep_all:
            joined = vertices.join(summed, "id", "left")
            fresh = joined.select("id", (base + damping * F.coalesce(F.col("got"), F.lit(0.0))).alias("rank"))
        else:
            fresh = summed.select("id", (base + damping * F.col("got")).alias("rank"))
        fresh = materialise(fresh, f"rank-{i}")
        if tolerance is not None:
            moved = ranks.withColumnRenamed("rank", "old").join(fresh, "id", "full")
            gap = F.max(F.abs(F.coalesce(F.col("rank"), F.lit(0.0)) - F.coalesce(F.col("old"), F.lit(0.0))))
            if (moved.agg(gap.alias("g")).first()["g"] or 0.0) <= tolerance:
                return fresh
        discard(ranks)
        ranks = fresh


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges ``u, v`` of a part replaced by those to the smallest vertex each end reaches within ``LOCAL_EDGES`` of them.

    Loops stay loops, so no vertex is lost.
    """

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = np.concatenate([np.stack([b.column(c).drop_null().to_numpy() for c in (0, 1)], axis=1) for b in held])
        ids, place = np.unique(ends, return_inverse=True)
        u, v = place.reshape(-1, 2).T
        root = np.arange(len(ids))
        while len(u):
            a, b = root[u], root[v]
            apart = a != b
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = root[root]
                if (above == root).all():
                    break
                root = above
        joined = np.zeros(len(ids), bool)
        joined[root[root != np.arange(len(ids))]] = True
        keep = ~joined  # a root is named by its leaves
        # the missing end of an open edge is a component by itself
        missing = [None] * any(pa.compute.any(b.column(2)).as_py() for b in held)
        return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(column[keep], pa.int64()), pa.array(missing, pa.int64())]) for column in (ids, ids[root])], ["u", "v"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= LOCAL_EDGES:
            yield stars(held)
            held, rows = [], 0
    if rows:
        yield stars(held)


def connected_components(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Smallest vertex of every component, by alternating stars (few rounds even for long chains).

    Edges that lie in one part are contracted there before anything is
    shuffled.  Rounds go on until nothing changes; a given ``max_rounds`` that
    does not suffice is an error.
    """
    ends = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
    both = ends.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"), (F.col("src").isNull() | F.col("dst").isNull()).alias("open"))
    begin = materialise(both.mapInArrow(_contracted, "u long, v long").distinct(), "contracted")
    pairs = begin.filter("u <> v")
    first = True
    mark = _state(pairs)
    for i in count():
        if i == max_rounds:
            raise RuntimeError(f"components have not settled in {max_rounds} rounds")
        # large star: larger neighbours of every vertex move to the smallest one around it
        around = pairs.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
            pairs.select(F.col("v").alias("a"), F.col("u").alias("b"))
        )
        least = materialise(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("__n")), f"least-{i}")
        large = (
            spread_join(around, least.select("a", "m"), "a", "b", hot=hot_keys(least, "a"))
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        large = materialise(large, f"large-{i}")
        # small star: smaller neighbours and the vertex itself move to the smallest one
        lowest = materialise(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("__n")), f"lowest-{i}")
        small = (
            spread_join(large, lowest.select("u", "m"), "u", "v", hot=hot_keys(lowest, "u"))
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        before, pairs = pairs, materialise(small, f"small-{i}")
        if not first:
            discard(before)
        first = False
        for used in (least, large, lowest):
            discard(used)
        state = _state(pairs)
        if mark == state:
            break
        mark = state
    roots = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    # Every vertex that is not a root is the larger end of one pair.
    tops = roots.select(F.col("component").alias("id")).unionByName(begin.filter("u = v OR u IS NULL").select(F.col("u").alias("id"))).distinct()
    alone = null_safe_join(tops, roots.select("id", F.lit(True).alias("has")), ["id"]).filter("has IS NULL")
    return roots.unionByName(alone.select("id", F.col("id").alias("component")))


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first())


def _triangles(edges: np.ndarray, same: np.ndarray, mixed: bool) -> tuple[np.ndarray, np.ndarray]:
    """Vertices of edges ``(a, b)`` with their triangles; in a ``mixed`` set, not those of three ``same`` edges.

    Arcs point from the end of smaller degree to the larger; what two arcs
    span is looked up among the arcs, some millions at once.
    """
    ids, place = np.unique(edges, return_inverse=True)
    place, n = place.reshape(-1, 2), len(ids)
    degree = np.bincount(place.ravel(), minlength=n)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((np.arange(n), degree))] = np.arange(n)
    ends = np.sort(rank[place], axis=1)
    key = ends[:, 0] * n + ends[:, 1]
    order = np.argsort(key)
    key, same = key[order], same[order]
    x, y = key // n, key % n
    start = np.searchsorted(x, np.arange(n + 1))
    fan = start[y + 1] - start[y]
    total = np.concatenate([[0], np.cumsum(fan)])
    found, low = np.zeros(n, np.int64), 0
    while low < len(key):
        high = max(low + 1, int(np.searchsorted(total, total[low] + TRIANGLE_EDGES, side="right")) - 1)
        first = np.repeat(np.arange(low, high), fan[low:high])
        second = np.arange(total[low], total[high]) - total[first] + start[y[first]]
        wanted = x[first] * n + y[second]
        third = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        hit = key[third] == wanted
        if mixed:
            hit &= ~(same[first] & same[second] & same[third])
        for corner in (x[first[hit]], y[first[hit]], y[second[hit]]):
            found += np.bincount(corner, minlength=n)
        low = high
    in_order = found[rank]
    return ids[in_order > 0], in_order[in_order > 0]


def triangle_counts(edges: DataFrame) -> DataFrame:
    """Triangles per vertex.

    Vertices get one of some colours.  An edge goes to every set of three
    colours that holds those of its ends, and a triangle is found in the set of
    its own colours: edges are shuffled once per colour, paths of two edges
    never.  The colours are as many as keep the edges of a set near
    ``TRIANGLE_EDGES``.
    """
    edges = materialise(edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst")), "edges")
    plain = materialise(
        edges.filter("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct(), "plain"
    )
    colours = max(1, -int(-((6 * plain.count() / TRIANGLE_EDGES) ** 0.5) // 1))
    colour = lambda c: F.pmod(F.xxhash64(c), F.lit(colours))
    sets = F.transform(F.sequence(F.lit(0), F.lit(colours - 1)).cast("array<long>"), lambda r: F.array_sort(F.array(colour("a"), colour("b"), r)))
    sent = plain.select("a", "b", (colour("a") == colour("b")).alias("same"), F.explode(sets).alias("s")).select(
        "a", "b", "same", ((F.col("s")[0] * colours + F.col("s")[1]) * colours + F.col("s")[2]).alias("set")
    )

    def within(key: tuple, held: pa.Table) -> pa.Table:
        number = key[0].as_py()
        ends = np.stack([held.column(c).to_numpy() for c in ("a", "b")], axis=1)
        one = number // (colours * colours) == number // colours % colours == number % colours
        ids, n = _triangles(ends, held.column("same").to_numpy(), not one)
        return pa.Table.from_arrays([pa.array(ids), pa.array(n)], ["id", "n"])

    counted = sent.groupBy("set").applyInArrow(within, "id long, n long").groupBy("id").agg(F.sum("n").alias("triangles"))
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return vertices.join(counted, "id", "left").select("id", F.coalesce("triangles", F.lit(0)).alias("triangles"))


def shortest_paths(edges: DataFrame, source: int, weight: str = "weight", max_rounds: int | None = None) -> DataFrame:
    """Distance from one vertex along weighted edges; unreached vertices are absent."""
    links = materialise(edges.select("src", "dst", F.col(weight).cast("double").alias("w")), "weighted")
    hot = hot_keys(rows_per(links, "src"), "src")
    links = salted(links, "src", "dst", hot)
    spark = edges.sparkSession
    dist = materialise(spark.createDataFrame([(source, 0.0)], "id long, distance double"), "dist")
    frontier = dist
    for i in count():
        if i == max_rounds:
            raise RuntimeError(f"paths have not ended in {max_rounds} rounds")
        copies = per_salt(frontier, "id", hot).withColumnRenamed("salt", "__salt")
        reached = (
            links.join(copies, (F.col("src") == F.col("id")) & (F.col("salt") == F.col("__salt")))
            .groupBy(F.col("dst").alias("id"))
            .agg(F.min(F.col("distance") + F.col("w")).alias("fresh"))
        )
        better = reached.join(dist, "id", "left").filter(F.col("distance").isNull() | (F.col("fresh") < F.col("distance")))
        reached_before, frontier = frontier, materialise(better.select("id", F.col("fresh").alias("distance")), f"frontier-{i}")
        if reached_before is not dist:
            discard(reached_before)
        if frontier.isEmpty():
            return dist
        before = dist
        dist = materialise(before.join(frontier.select("id"), "id", "left_anti").unionByName(frontier), f"dist-{i}")
        discard(before)


def transitive_closure(edges: DataFrame, sources: DataFrame | None = None, depth: int | None = None) -> DataFrame:
    """Pairs (src, dst) joined by a path; each round extends only the new pairs.

    All pairs can be the square of the vertices: ``sources`` (a column ``id``)
    keeps the paths that begin there, ``depth`` those of so many steps at most.
    """
    links = materialise(edges.select("src", "dst").distinct(), "links")
    begin = links if sources is None else links.join(sources.select(F.col("id").alias("src")).distinct(), "src", "left_semi")
    known = fresh = materialise(begin, "known")
    for i in count(1):
        if i == depth:
            return known
        longer = (
            spread_join(fresh.select("src", F.col("dst").alias("mid")), links.select(F.col("src").alias("mid"), "dst"), "mid", "src")
            .select("src", "dst")
            .distinct()
        )
        fresh = materialise(longer.join(known, ["src", "dst"], "left_anti"), f"fresh-{i}")
        if fresh.isEmpty():
            return known
        known = materialise(known.unionByName(fresh), f"known-{i}")


def older_neighbours(vertices: DataFrame, edges: DataFrame, age: str = "age") -> DataFrame:
    """Count and mean age of the followers that are older than the vertex itself."""
    a = vertices.select(F.col("id").alias("src"), F.col(age).alias("src_age"))
    b = vertices.select(F.col("id").alias("dst"), F.col(age).alias("dst_age"))
    edges = materialise(edges.select("src", "dst"), "edges")
    hot = hot_keys(rows_per(edges, "dst"), "dst")
    ends = spread_join(spread_join(edges, a, "src", "dst"), b, "dst", "src", hot=hot)
    sent = ends.filter("src_age > dst_age")
    return sent.groupBy(F.col("dst").alias("id")).agg(
        F.count(F.lit(1)).alias("older"), F.avg("src_age").alias("mean_age")
    )


def subgraph(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges whose two ends are among the vertices."""
    ids = vertices.select("id")
    edges = materialise(edges, "edges")
    hot = hot_keys(rows_per(edges, "dst"), "dst")
    inside = spread_join(edges, ids.withColumnRenamed("id", "src"), "src", "dst", "left_semi")
    return spread_join(inside, ids.withColumnRenamed("id", "dst"), "dst", "src", "left_semi", hot)


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def degree_histogram(edges: DataFrame) -> DataFrame:
    return degrees(edges).groupBy("degree").agg(F.count(F.lit(1)).alias("vertices"))
