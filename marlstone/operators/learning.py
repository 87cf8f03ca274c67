"""Learning jobs on ``pyspark.ml`` and on plain aggregates."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, scratch_path
from .ordered import Running, null_safe_join, running


def tokens(df: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    return RegexTokenizer(inputCol=text, outputCol=out, pattern=r"\s+", minTokenLength=1).transform(df)


def tfidf(df: DataFrame, text: str, size: int = 1 << 12) -> DataFrame:
    """Hashed term frequencies weighted by inverse document frequency, as ``features``."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="__tokens", pattern=r"\s+", minTokenLength=1),
        HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=size),
        IDF(inputCol="__tf", outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop("__tokens", "__tf")


def word_idf(df: DataFrame, key: str, text: str) -> DataFrame:
    """Document frequency and ``ln((n + 1) / (df + 1))`` per word."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    pairs = tokens(df, text).select(key, F.explode(F.array_distinct("tokens")).alias("word"))
    counted = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return counted.select("word", "df", F.log((total + 1) / (F.col("df") + 1)).alias("idf"))


def embedded(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Array column to a vector column ``features``."""
    return df.withColumn("features", array_to_vector(F.col(column).cast("array<double>")))


def assembled(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def accuracy_table(models: dict[str, object], train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy of each classifier on the test rows, beside that of the most frequent label."""
    rows = []
    counts = test.groupBy(label).count()
    top = counts.agg((F.max("count") / F.sum("count")).alias("b")).first()["b"]
    for name, estimator in models.items():
        predicted = estimator.fit(train).transform(test)
        hit = predicted.agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("a")).first()["a"]
        rows.append((name, float(hit), float(top)))
    return test.sparkSession.createDataFrame(rows, "model string, accuracy double, majority double")


def error_table(models: dict[str, object], train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Root mean squared error of each regressor, beside that of the mean."""
    rows = []
    spread = test.agg(F.stddev_pop(label).alias("s")).first()["s"]
    for name, estimator in models.items():
        predicted = estimator.fit(train).transform(test)
        error = predicted.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(label), 2))).alias("e")).first()["e"]
        rows.append((name, float(error), float(spread)))
    return test.sparkSession.createDataFrame(rows, "model string, rmse double, spread double")


# --- similarity ------------------------------------------------------------


def near_passages(left: DataFrame, right: DataFrame, left_id: str, right_id: str, text: str, least: float, width: int = 5) -> DataFrame:
    """Texts of ``left`` that hold a text of ``right``: at least the share ``least`` of its runs of ``width`` words.

    An equi-join on hashes of the distinct runs, counted by pair; so no pair
    is missed and none is tried that shares nothing.  Equal texts are joined
    once, any number of copies only fans out in the result.  A run that many
    texts share is a large key of a plain join, which the engine splits.
    """

    def runs(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        words = F.filter(F.split(F.lower(text), r"[ \t\n\r\f\x0b]+"), lambda w: w != "")
        known = df.select(key, words.alias("words")).filter(F.size("words") > 0).withColumn("digest", F.sha2(F.array_join("words", " "), 256))
        one = known.groupBy("digest").agg(F.any_value("words").alias("words"))
        starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(1)))
        grams = F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice("words", i, F.lit(width)), " "))))
        return known.select(key, "digest"), one.select("digest", F.size(grams).alias("n"), F.explode(grams).alias("gram"))

    ids_a, a = runs(left, left_id)
    ids_b, b = runs(right, right_id)
    both = a.select(F.col("digest").alias("da"), "gram").join(b.select(F.col("digest").alias("db"), "gram", "n"), "gram")
    shares = both.groupBy("da", "db").agg((F.count(F.lit(1)) / F.any_value("n")).alias("share")).filter(F.col("share") >= least)
    found = shares.join(ids_a.withColumnRenamed("digest", "da"), "da").join(ids_b.withColumnRenamed("digest", "db"), "db")
    return found.select(left_id, right_id, "share")


def nearest(df: DataFrame, key: str, wanted: int, k: int = 10, column: str = "embedding") -> DataFrame:
    """The ``k`` nearest vectors of one row: exact, one pass, each task keeps its own ``k``."""
    point = df.filter(F.col(key) == wanted).select(column).first()[column]
    gaps = F.zip_with(column, F.array(*[F.lit(float(v)) for v in point]), lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    distance = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x))
    return df.select(key, distance.alias("distance")).orderBy("distance", key).limit(k)


# --- statistics ------------------------------------------------------------


def kernel_density(df: DataFrame, column: str, points: Sequence[float], bandwidth: float) -> DataFrame:
    """Gaussian density at a few points, all from one pass."""
    norm = 1.0 / (bandwidth * math.sqrt(2 * math.pi))
    z = [(F.col(column) - p) / bandwidth for p in points]
    row = df.agg(*[F.avg(F.exp(-0.5 * v * v) * norm).alias(f"__d{i}") for i, v in enumerate(z)])
    items = [F.struct(F.lit(float(p)).alias("point"), F.col(f"__d{i}").alias("density")) for i, p in enumerate(points)]
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Independence statistic and degrees of freedom of two columns."""
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy("a").agg(F.sum("n").alias("ra"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("rb"))
    total = cells.agg(F.sum("n").alias("t")).scalar()
    joined = null_safe_join(null_safe_join(cells, rows, ["a"]), cols, ["b"])
    expected = F.col("ra") * F.col("rb") / total
    # pairs that never occur add their expectation, which is the total minus what is seen
    seen = joined.agg(
        F.sum(F.pow(F.col("n") - expected, 2) / expected).alias("s"), F.sum(expected).alias("e"), F.sum("n").alias("t"),
    )
    freedom = (rows.agg((F.count(F.lit(1)) - 1).alias("x")).scalar()) * (cols.agg((F.count(F.lit(1)) - 1).alias("x")).scalar())
    return seen.select((F.col("s") + F.col("t") - F.col("e")).alias("statistic"), freedom.alias("freedom"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` written and computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Terms of the sums below; both have long settled by then for up to some ten thousand degrees of freedom.
TERMS = 2000


def chi_square_tail(statistic: Column, freedom: Column) -> Column:
    """Probability of a larger chi-square value: the upper incomplete gamma function of halves.

    Below the mean by the power series of the lower function, above it by the
    continued fraction of the upper one.  Null without degrees of freedom.
    """
    steps = F.sequence(F.lit(1), F.lit(TERMS))

    def tail(a: Column, x: Column) -> Column:
        # ln gamma(a), a multiple of one half, by its recurrence from gamma(1) = 1 or gamma(1/2).
        whole = F.floor(a) == a
        start = F.when(whole, F.lit(0.0)).otherwise(F.lit(math.log(math.pi) / 2))
        least = F.when(whole, F.lit(1.0)).otherwise(F.lit(0.5))
        count = (a - least).cast("int")
        factors = F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: i < count)
        log_gamma = F.aggregate(factors, start, lambda s, i: s + F.ln(least + i))
        scale = F.exp(a * F.ln(x) - x - log_gamma)
        series = F.aggregate(
            steps, F.struct((1 / a).alias("term"), (1 / a).alias("sum")),
            lambda s, n: _let(s["term"] * x / (a + n), lambda t: F.struct(t.alias("term"), (s["sum"] + t).alias("sum"))), lambda s: s["sum"],
        )
        # Lentz' method for 1 / (x + 1 - a - 1 (1 - a) / (x + 3 - a - ...)).
        tiny = 1e-300
        begin = x + 1 - a
        first = F.struct(F.lit(1 / tiny).alias("c"), F.try_divide(F.lit(1.0), begin).alias("d"), F.try_divide(F.lit(1.0), begin).alias("h"))

        def step(s: Column, n: Column) -> Column:
            part, b = n * (a - n), begin + 2 * n
            d, c = F.try_divide(F.lit(1.0), b + part * s["d"]), b + F.try_divide(part, s["c"])
            return _let(F.struct(d.alias("d"), c.alias("c")), lambda m: F.struct(m["c"].alias("c"), m["d"].alias("d"), (s["h"] * m["c"] * m["d"]).alias("h")))

        fraction = F.aggregate(steps, first, step, lambda s: s["h"])
        return F.when(x <= 0, F.lit(1.0)).when(x < a + 1, 1 - scale * series).otherwise(scale * fraction)

    halves = F.struct((freedom / 2).cast("double").alias("a"), (statistic / 2).cast("double").alias("x"))
    return F.when(freedom > 0, _let(halves, lambda h: tail(h["a"], h["x"])))


def chi_square_fit(df: DataFrame, column: str, expected: DataFrame | None = None) -> DataFrame:
    """Goodness of fit of a column's counts: ``statistic``, ``freedom``, ``p_value``.

    ``expected`` has ``value`` and ``share``, in any unit; without it all
    values that occur are as likely.  A value that occurs and has no share has
    an infinite statistic, one with a share that does not occur counts in full.
    Null is a value.
    """
    seen = df.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if expected is None:
        both = seen.withColumn("share", F.lit(1.0))
    else:
        shares = expected.groupBy("value").agg(F.sum("share").cast("double").alias("share"))
        theirs = shares.withColumnRenamed("value", "__v")
        joined = seen.join(theirs, seen["value"].eqNullSafe(theirs["__v"]), "full")
        both = joined.select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("share", F.lit(0.0)).alias("share"))
    # sum((n - e)^2 / e) = sum(n^2 / e) - total, as observed and expected counts add up alike.
    total = both.agg(F.sum("n").alias("n"), F.sum("share").alias("s"), F.count(F.lit(1)).alias("k"), F.sum(F.try_divide(F.col("n") * F.col("n").cast("double"), F.col("share"))).alias("q"), F.max((F.col("share") == 0) & (F.col("n") > 0)).alias("odd"))
    statistic = F.when(F.col("odd"), F.lit(math.inf)).otherwise(F.col("q") * F.col("s") / F.col("n") - F.col("n"))
    found = total.where("n > 0").select(F.greatest(statistic, F.lit(0.0)).alias("statistic"), (F.col("k") - 1).alias("freedom"))
    certain = F.when(F.col("statistic") == math.inf, F.lit(0.0)).otherwise(chi_square_tail(F.col("statistic"), F.col("freedom")))
    return found.select("statistic", "freedom", certain.alias("p_value"))


def rank_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Spearman's correlation of two columns as ``spearman``: equal values share their mean rank.

    Equal pairs are counted first, ranks belong to values and not to rows.
    """
    pairs = materialise(df.groupBy(F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b")).agg(F.count(F.lit(1)).alias("n")), "pairs")
    joined = pairs
    for name in ("a", "b"):
        counted = pairs.groupBy(name).agg(F.sum("n").alias("copies"))
        placed = running(counted, [], [(name, True)], {"upto": Running("sum", "copies")})
        joined = joined.join(placed.select(name, (F.col("upto") - (F.col("copies") - 1) / 2).alias(f"{name}_rank")), name)
    middle = (pairs.agg(F.sum("n").alias("n")).scalar() + 1) / 2
    x, y, n = F.col("a_rank") - middle, F.col("b_rank") - middle, F.col("n")
    sums = joined.agg(F.sum(n * x * y).alias("xy"), F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy"))
    scale = F.sqrt("xx") * F.sqrt("yy")
    return sums.select(F.when(scale > 0, F.col("xy") / scale).otherwise(F.lit(math.nan)).alias("spearman"))


def normal_share(column: Column, mean: Column, deviation: Column) -> Column:
    """Share of a normal distribution up to a value, by the series of the error function."""
    z = (column - mean) / (deviation * math.sqrt(2))

    def share(z: Column) -> Column:
        terms = F.aggregate(
            F.sequence(F.lit(1), F.lit(120)), F.struct(z.alias("term"), z.alias("sum")),
            lambda s, n: _let(s["term"] * 2 * z * z / (2 * n + 1), lambda t: F.struct(t.alias("term"), (s["sum"] + t).alias("sum"))), lambda s: s["sum"],
        )
        inner = 0.5 + terms * F.exp(-z * z) / math.sqrt(math.pi)
        return F.when(z > 5.5, F.lit(1.0)).when(z < -5.5, F.lit(0.0)).otherwise(inner)

    return _let(z.cast("double"), share)


def kolmogorov_distance(df: DataFrame, column: str, share: Callable[[Column], Column]) -> DataFrame:
    """Largest distance of a column's shares from ``share`` of its values: ``statistic``, ``n``, ``p_value``.

    Exact: every value is ranked, chunk by chunk, so no task sees them all.
    Nulls are left out.  The p-value is that of long columns (Kolmogorov's sum).
    """
    known = df.select(F.col(f"`{column}`").cast("double").alias("v")).where("v IS NOT NULL")
    ranked = running(known, [], [("v", True)], {"place": Running("row_number")})
    total = known.agg(F.count(F.lit(1)).alias("n")).scalar()
    own = share(F.col("v"))
    apart = ranked.select(own.alias("share"), "place", total.alias("n")).agg(
        F.max(F.greatest(F.col("place") / F.col("n") - F.col("share"), F.col("share") - (F.col("place") - 1) / F.col("n"))).alias("statistic"), F.max("n").alias("n")
    )
    lam = F.col("statistic") * F.sqrt("n")
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, j: s + 2 * F.pow(F.lit(-1.0), j - 1) * F.exp(-2 * j * j * lam * lam))
    p = F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(terms, F.lit(0.0)), F.lit(1.0)))
    return apart.where("n > 0").select("statistic", "n", p.alias("p_value"))


# --- matrices --------------------------------------------------------------


def gram(df: DataFrame, column: str) -> DataFrame:
    """Entries ``(i, j, value)`` of X'X: one product per batch, then one sum."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[column].to_numpy()).astype(float)
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            n = total.shape[0]
            i, j = np.meshgrid(np.arange(n), np.arange(n), indexing="ij")
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "value": total.ravel()})

    parts = df.select(column).mapInPandas(partial, "i int, j int, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


def column_similarities(df: DataFrame, column: str) -> DataFrame:
    """Cosine of every pair of columns i < j."""
    g = gram(df, column)
    norms = g.filter("i = j")
    a = norms.select("i", F.sqrt("value").alias("na"))
    b = norms.select("j", F.sqrt("value").alias("nb"))
    return g.filter("i < j").join(a, "i").join(b, "j").select("i", "j", F.try_divide(F.col("value"), F.col("na") * F.col("nb")).alias("cosine"))


def singular_values(df: DataFrame, column: str, k: int) -> tuple[DataFrame, np.ndarray]:
    """The ``k`` largest singular values and the right vectors.

    Only the small square matrix (side = vector length) reaches the driver.
    """
    entries = gram(df, column).toPandas()
    n = int(entries["i"].max()) + 1
    matrix = np.zeros((n, n))
    matrix[entries["i"], entries["j"]] = entries["value"]
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:k]
    sigma = np.sqrt(np.maximum(values[order], 0.0))
    rows = [(i, float(s)) for i, s in enumerate(sigma)]
    return df.sparkSession.createDataFrame(rows, "rank int, sigma double"), vectors[:, order]


# --- word vectors ----------------------------------------------------------

#: Words trained in one task, centres of one step, and the most that a vector moves in a step, in single moves.
BLOCK_WORDS, STEP_CENTRES, MOST_MOVES = 400_000, 512, 64
#: Pieces of a step, by length of the paths.
PIECES = 3
#: Words of one sentence at most; the rest of a text begins another one.
SENTENCE = 1000


def huffman_runs(classes: Sequence[tuple[int, int]]) -> tuple[dict[int, int], dict[str, np.ndarray]]:
    """Huffman's tree of ``(weight, number of leaves)`` classes, by runs of nodes of one weight.

    Returns the number of each class's first leaf, and stretches of nodes:
    from ``low`` on, node i is at ``off + i - low`` in a row whose nodes 2j and
    2j + 1 have the parent ``base + j``.  The root lies in none.
    """
    heap, first, nodes, order = [], {}, 0, count()
    for weight, n in sorted(classes):
        first[weight] = nodes
        heap.append((weight, next(order), nodes, nodes + n))
        nodes += n
    heapq.heapify(heap)
    stretches = []  # (low, off, base)
    while heap:
        weight, _, low, high = heapq.heappop(heap)
        row = [(low, high)]
        while heap and heap[0][0] == weight:
            row.append(heapq.heappop(heap)[2:])
        total, off = sum(b - a for a, b in row), 0
        for a, b in row:
            stop = min(b, a + max(0, total - total % 2 - off))
            if stop > a:
                stretches.append((a, off, nodes))
            off += b - a
        if total > 1:
            heapq.heappush(heap, (2 * weight, next(order), nodes, nodes + total // 2))
            nodes += total // 2
        if total % 2 and heap:
            last = row[-1][1] - 1
            other, _, low, high = heapq.heappop(heap)
            stretches += [(last, 0, nodes), (low, 1, nodes)]
            if high > low + 1:
                heapq.heappush(heap, (other, next(order), low + 1, high))
            heapq.heappush(heap, (weight + other, next(order), nodes, nodes + 1))
            nodes += 1
    columns = np.array(sorted(stretches), np.int64).reshape(-1, 3).T
    return first, {"low": columns[0], "off": columns[1], "base": columns[2], "root": np.int64(nodes - 1)}


def _paths(leaves: np.ndarray, tree: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Inner nodes above every leaf, up to the root, and the side taken at each (-1 beyond the root)."""
    at, points, sides = leaves.astype(np.int64), [], []
    while (below := at != tree["root"]).any():
        i = np.maximum(np.searchsorted(tree["low"], at, side="right") - 1, 0)
        place = tree["off"][i] + at - tree["low"][i]
        at = np.where(below, tree["base"][i] + place // 2, at)
        points.append(at)
        sides.append(np.where(below, place % 2, -1))
    shape = (len(leaves), -1)
    return np.stack(points, axis=1) if points else np.zeros((len(leaves), 0), np.int64), np.stack(sides, axis=1).reshape(shape) if sides else np.zeros((len(leaves), 0), np.int64)


def _add_rows(target: np.ndarray, rows: np.ndarray, moves: np.ndarray, times: np.ndarray) -> None:
    """Add moves, sums of ``times`` single ones, to rows that may come repeatedly; a row's count as ``MOST_MOVES`` at most."""
    if not len(rows):
        return
    # Rows and their places sorted as one number each, which costs a third of an argsort.
    named = np.sort(rows.astype(np.int64) << 32 | np.arange(len(rows)))
    own, order = named >> 32, named & 0xFFFFFFFF
    start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    share = np.minimum(1.0, MOST_MOVES / np.maximum(np.add.reduceat(times.take(order), start), 1)).astype(np.float32)
    target[own[start]] += np.add.reduceat(moves.take(order, axis=0), start) * share[:, None]


def _trained(sentences: list[np.ndarray], vectors: np.ndarray, points: np.ndarray, sides: np.ndarray, window: int, rate: float, rng: np.random.Generator) -> np.ndarray:
    """One pass of skip-gram with hierarchical softmax over sentences of word numbers."""
    inner = np.unique(points)
    points, sides = np.searchsorted(inner, points).astype(np.int32), sides.astype(np.float32)
    lengths = (sides >= 0).sum(axis=1)
    weights = np.zeros((len(inner), vectors.shape[1]), np.float32)
    words = np.concatenate(sentences)
    sentence = np.repeat(np.arange(len(sentences)), [len(x) for x in sentences])
    offsets = np.array([d for d in range(-window, window + 1) if d])
    step = min(STEP_CENTRES, max(16, len(vectors) // 4))  # few words would meet one another too often in a long step
    for start in range(0, len(words), step):
        centre = np.arange(start, min(start + step, len(words)))
        near = centre[:, None] + offsets
        inside = (near >= 0) & (near < len(words)) & (np.abs(offsets) <= rng.integers(1, window + 1, len(centre))[:, None])
        inside &= sentence[np.clip(near, 0, len(words) - 1)] == sentence[centre][:, None]
        # All pairs of a centre share its path, so they are worked on together: centre, neighbour or node, dimension.
        told = words[centre]
        places = words[np.clip(np.arange(start - window, centre[-1] + window + 1), 0, len(words) - 1)]
        there, slots = vectors.take(places, axis=0), np.arange(len(centre))[:, None] + offsets + window
        alpha = np.float32(rate * max(1e-4, 1 - start / len(words)))
        above_moves, moved = [], np.empty((len(centre), len(offsets), vectors.shape[1]), np.float32)
        # Centres with paths of like lengths together, so that little is worked out beyond a path's end.
        for some in np.array_split(np.argsort(lengths[told]), min(PIECES, len(centre))):
            longest = lengths[told[some]].max()
            path, side = points[told[some], :longest], sides[told[some], :longest]
            used = side >= 0
            own, above = there.take(slots[some], axis=0), weights.take(path, axis=0)
            pull = own @ above.transpose(0, 2, 1)
            # as in the library, nothing is learned beyond a score of 6
            known = np.abs(pull) < 6
            known &= inside[some][:, :, None]
            known &= used[:, None, :]
            np.negative(pull, out=pull)
            with np.errstate(over="ignore"):
                np.exp(pull, out=pull)
            pull += 1
            np.divide(alpha, pull, out=pull)
            np.subtract(((1 - side) * alpha)[:, None, :], pull, out=pull)
            pull *= known
            moved[some] = pull @ above
            # as numbers of a byte, of which there is one for each neighbour
            times = known.view(np.uint8).sum(axis=1, dtype=np.uint8) if len(offsets) < 256 else known.sum(axis=1)
            above_moves.append((path[used], (pull.transpose(0, 2, 1) @ own)[used], times[used].astype(np.int64)))
        _add_rows(weights, *map(np.concatenate, zip(*above_moves, strict=True)))
        # What the neighbours of all centres add to a place first, then what places add to a word.
        sums, times = np.zeros_like(there), np.zeros(len(places), np.int64)
        for k, off in enumerate(offsets + window):
            sums[off : off + len(centre)] += moved[:, k]
            times[off : off + len(centre)] += inside[:, k]
        _add_rows(vectors, places[times > 0], sums[times > 0], times[times > 0])
    return vectors


def word_vectors(df: DataFrame, column: str, size: int, window: int = 5, rate: float = 0.025, seed: int = 0) -> DataFrame:
    """A vector per word of an array column, as ``word, vector``: skip-gram with hierarchical softmax, one pass.

    As in the library, parts of the texts are trained apart from the same
    beginning and a word's vectors are averaged.  The vocabulary stays in
    DataFrames: a part holds the words that occur in it, and Huffman's tree is
    made from the counts of counts, of which there are few.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, room = TaskContext.get().partitionId(), 0, BLOCK_WORDS
        for batch in batches:
            own = []
            for n in pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_pylist():
                if n > room:
                    number, room = number + 1, BLOCK_WORDS
                room -= n
                own.append((part << 32) + number)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), batch.column(0)], ["block", "words"])

    texts = materialise(df.select(F.col(column).alias("words")).mapInArrow(blocks, "block long, words array<string>"), "blocks")
    # Counted per block once; a word comes once per block from here on.
    occurring = materialise(
        texts.select("block", F.explode("words").alias("word")).where("word IS NOT NULL").groupBy("block", "word").agg(F.count(F.lit(1)).alias("n")), "block-words"
    )
    vocabulary = materialise(occurring.groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    first, tree = huffman_runs([(r["n"], r["c"]) for r in vocabulary.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()])
    numbered = running(vocabulary, ["n"], [("word", True)], {"place": Running("row_number")}).select("word", F.col("n").alias("total"), "place")
    known = occurring.join(numbered, "word").select("block", "word", "total", "place", F.xxhash64(F.lit(seed), "word").alias("h"))

    def train(key: tuple, held: pa.Table, words: pa.Table) -> pa.Table:
        if not words.num_rows:
            return pa.table({"word": pa.array([], pa.string()), "vector": pa.array([], pa.list_(pa.float32()))})
        words = words.sort_by("word")
        own = words.column("word").combine_chunks()
        leaves = np.array([first[n] for n in words.column("total").to_pylist()], np.int64) + words.column("place").to_numpy() - 1
        points, sides = _paths(leaves, tree)
        state = words.column("h").to_numpy().astype(np.uint64)[:, None] + np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            state = (state ^ (state >> np.uint64(shift))) * np.uint64(factor)
        vectors = (((state >> np.uint64(40)).astype(np.float32) / (1 << 24) - 0.5) / size).astype(np.float32)
        # All words are looked up at once: a lookup first takes in the words it is to know.
        texts = held.column("words").combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy()
        numbers = pc.fill_null(pc.index_in(texts.flatten(), own), -1).to_numpy()
        numbers = [x[x >= 0] for x in np.split(numbers, np.cumsum(sizes)[:-1])]
        # Texts of a block may come in any order; by number is by word.
        numbers.sort(key=lambda x: x.astype(">i4").tobytes())
        sentences = [x[i : i + SENTENCE] for x in numbers for i in range(0, len(x), SENTENCE)]
        if sides.shape[1] and sentences:
            vectors = _trained(sentences, vectors, points, sides, window, rate, np.random.default_rng(seed))
        return pa.table({"word": own, "vector": pa.array(list(vectors), pa.list_(pa.float32()))})

    parts = texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(train, "word string, vector array<float>")
    # One count for all dimensions: averages would shuffle one for each.
    sums = parts.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("vector")[i]).alias(f"v{i}") for i in range(size)])
    return materialise(sums.select("word", F.array(*[(F.col(f"v{i}") / F.col("n")).cast("float") for i in range(size)]).alias("vector")), "word-vectors")


# --- products --------------------------------------------------------------

#: Directions that left vectors are told apart by, and left vectors compared in one task.
CONES, CONE_ROWS = 512, 20_000


def _batch(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a batch of ``id, features``."""
    vectors = batch.column(batch.schema.get_field_index("features"))
    return batch.column(batch.schema.get_field_index("id")).to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products in single precision, added from left to right as the library does."""
    left, right = left.astype(np.float32), right.astype(np.float32)
    out = np.zeros((len(left), len(right)), np.float32)
    for k in range(left.shape[1]):
        out += left[:, k, None] * right[None, :, k]
    return out


def top_products(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """For every left vector the ``k`` right ones of the largest inner product: ``left, right, product``.

    Both frames hold ``id, features``; equal products go by the smaller id.
    Exact, without comparing all with all: left vectors fall to the nearest of
    some directions.  The best right vectors of these directions give each left
    vector a product that its k-th best reaches at least; a right vector is
    compared with the left ones of a direction only if, within the box they
    fill, it can come up to the least of these.
    """
    first = right.select(F.size("features").alias("d")).first()
    if first is None:
        return left.limit(0).select(F.col("id").alias("left"), F.col("id").alias("right"), F.lit(0.0).cast("float").alias("product"))
    size = first["d"]
    drawn = left.select("features").orderBy(F.xxhash64("id"), "id").limit(CONES).collect()
    if not drawn:
        return left.select(F.col("id").alias("left"), F.col("id").alias("right"), F.lit(0.0).cast("float").alias("product"))
    axes = np.array([r["features"] for r in drawn], dtype=float)
    axes = axes / np.maximum(np.linalg.norm(axes, axis=1, keepdims=True), 1e-300)

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            ids, x = _batch(batch, size)
            if len(ids):
                score = axes @ x.T.astype(float)
                for c, row in enumerate(score):
                    best = np.argpartition(-row, min(k, len(row)) - 1)[:k]
                    held[c] = sorted([*held.get(c, []), *((float(row[i]), int(ids[i]), x[i].tolist()) for i in best)], key=lambda e: (-e[0], e[1]))[:k]
        flat = [(c, *e) for c, found in held.items() for e in found]
        if flat:
            columns = [pa.array(list(v), t) for v, t in zip(zip(*flat), (pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.float32())))]
            yield pa.RecordBatch.from_arrays(columns, ["cone", "score", "id", "features"])

    per_part = right.select("id", "features").mapInArrow(strongest, "cone int, score double, id long, features array<float>")
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id", "features"))), 1, k)
    best = per_part.groupBy("cone").agg(top.alias("b")).select(F.explode("b").alias("b")).select("b.id", "b.features").dropDuplicates(["id"])
    champions = np.array([r["features"] for r in best.orderBy("id").collect()], dtype=float)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, u = _batch(batch, size)
            norm = np.linalg.norm(u.astype(float), axis=1, keepdims=True)
            unit = u.astype(float) / np.maximum(norm, 1e-300)
            cone = np.argmax(unit @ axes.T, axis=1).astype(np.int32)
            reached = np.full(len(ids), -np.inf)
            if len(champions) >= k:
                reached = np.partition(unit @ champions.T, len(champions) - k, axis=1)[:, len(champions) - k]
            # All products of a vector of zeros are alike: it need not widen the box of others.
            cone[norm[:, 0] == 0] = -1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), batch.column(batch.schema.get_field_index("features")).cast(pa.list_(pa.float32())), pa.array(cone), pa.array(reached), pa.array(unit.tolist(), pa.list_(pa.float64()))],
                ["id", "features", "cone", "reached", "unit"],
            )

    lefts = materialise(left.select("id", "features").mapInArrow(placed, "id long, features array<float>, cone int, reached double, unit array<double>"), "cones")
    sides = [f(F.col("unit")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(size)]
    boxes = lefts.groupBy("cone").agg(F.count(F.lit(1)).alias("n"), F.min("reached").alias("least"), *sides).collect()
    pieces = {b["cone"]: -(-b["n"] // CONE_ROWS) for b in boxes}
    boxes = [b for b in boxes if b["cone"] >= 0]
    cones = np.array([b["cone"] for b in boxes], np.int32)
    low, high = (np.array([[b[f"{n}{i}"] for i in range(size)] for b in boxes]).reshape(-1, size) for n in ("low", "high"))
    least = np.array([b["least"] for b in boxes])

    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                ids, x = _batch(whole.slice(start, 4096), size)
                x = x.astype(float)
                most = np.maximum(x, 0) @ high.T + np.minimum(x, 0) @ low.T
                slack = 1e-5 * np.abs(x).sum(axis=1, keepdims=True)  # products are rounded
                at, c = np.nonzero(~(most + slack < least - 1e-5 * np.abs(least)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cones[c]), pa.array(ids[at], pa.int64()), pa.array(list(x[at]), pa.list_(pa.float32()))], ["cone", "id", "features"]
                )

    chosen = right.select("id", "features").mapInArrow(fitting, "cone int, id long, features array<float>")
    if -1 in pieces:
        chosen = chosen.unionByName(right.select(F.lit(-1).alias("cone"), F.col("id").cast("long").alias("id"), F.col("features").cast("array<float>").alias("features")).orderBy("id").limit(k))
    number = F.create_map(*[F.lit(int(v)) for pair in pieces.items() for v in pair])[F.col("cone")]
    chosen = chosen.withColumn("piece", F.explode(F.sequence(F.lit(0), number - 1)))
    lefts = lefts.select("id", "features", "cone", F.pmod(F.xxhash64("id"), number).cast("int").alias("piece"))

    def compared(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            b = b.sort_by("id")
            (own, u), (ids, x) = ((t.column("id").to_numpy(), t.column("features").combine_chunks().flatten().to_numpy().reshape(-1, size)) for t in (a, b))
            step = max(1, 4_000_000 // len(x))
            for start in range(0, len(u), step):
                product = _products(u[start : start + step], x)
                rows = np.arange(len(product))
                for _ in range(min(k, len(x))):
                    place = np.argmax(product, axis=1)
                    out.append((own[start : start + step], ids[place], product[rows, place]))
                    product[rows, place] = -np.inf
        columns = [np.concatenate(v) for v in zip(*out)] if out else [[], [], []]
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(columns, (pa.int64(), pa.int64(), pa.float32()))], ["left", "right", "product"])

    pairs = lefts.groupBy("cone", "piece").cogroup(chosen.groupBy("cone", "piece")).applyInArrow(compared, "left long, right long, product float")
    return pairs.select(F.col("left").cast(left.schema["id"].dataType), F.col("right").cast(right.schema["id"].dataType), "product")


# --- iterations ------------------------------------------------------------


def logistic_descent(df: DataFrame, features: Sequence[str], label: str, rounds: int, rate: float) -> DataFrame:
    """Logistic regression by gradient descent: one aggregate per round."""
    names = ["intercept", *features]
    data = materialise(df.select(F.lit(1.0).alias("intercept"), *[F.col(c).cast("double") for c in features], F.col(label).cast("double").alias("__y")), "descent")
    weights = [0.0] * len(names)
    for _ in range(rounds):
        score = sum((F.col(n) * w for n, w in zip(names, weights)), F.lit(0.0))
        gap = 1.0 / (1.0 + F.exp(-score)) - F.col("__y")
        row = data.agg(*[F.avg(gap * F.col(n)).alias(f"g{i}") for i, n in enumerate(names)]).first()
        weights = [w - rate * row[f"g{i}"] for i, w in enumerate(weights)]
    return df.sparkSession.createDataFrame(list(zip(names, [float(w) for w in weights])), "feature string, weight double")


def _nearest_centre(vector: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Index of the closest centre."""
    distances = F.array(
        *[
            F.aggregate(
                F.zip_with(vector, F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b)),
                F.lit(0.0),
                lambda s, x: s + x,
            )
            for centre in centres
        ]
    )
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def update_centres(
    batch: DataFrame, column: str, centres: list[list[float]], weights: list[float], decay: float
) -> tuple[list[list[float]], list[float]]:
    """Move the centres by one batch; older batches count ``decay`` each."""
    placed = batch.select(_nearest_centre(F.col(column), centres).alias("c"), F.posexplode(column).alias("p", "v"))
    sums = placed.groupBy("c", "p").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    centres = [list(c) for c in centres]
    weights = [w * decay for w in weights]
    counts = {r["c"]: r["n"] for r in sums}
    for r in sums:
        old, n = weights[r["c"]], r["n"]
        centres[r["c"]][r["p"]] = (centres[r["c"]][r["p"]] * old + r["s"]) / (old + n)
    for c, n in counts.items():
        weights[c] += n
    return centres, weights


def stream_state(
    stream: DataFrame, start: DataFrame, step: Callable[[DataFrame, list[Row]], DataFrame], name: str,
    path: str | None = None, checkpoint: str | None = None,
) -> DataFrame:
    """The state after the last available micro-batch; ``step(batch, rows of the state before)`` gives the next.

    ``start`` is the state before the first batch, a few rows.  The state after
    batch n is written to a folder of its own, and the batch counts as done
    only after that.  Batch n always reads the state after n - 1: repeated
    after a stop it starts from there again, so no row counts twice.  With the
    same ``path`` and ``checkpoint`` another driver goes on where one stopped.
    """
    from ..streaming.runner import run_batches

    spark = stream.sparkSession
    path = path or scratch_path(spark, name)

    def after(number: int) -> DataFrame:
        return spark.read.schema(start.schema).parquet(f"{path}/batch={number}") if number >= 0 else start

    def each(batch: DataFrame, number: int) -> None:
        made = step(batch, after(number - 1).collect())
        made.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    run_batches(stream, each, name, checkpoint=checkpoint)
    written = spark.read.schema(T.StructType([*start.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    newest = written.agg(F.max("batch")).first()[0]
    return after(-1 if newest is None else newest)


_CENTRES = "cluster int, centre array<double>, weight double"


def stream_k_means(
    stream: DataFrame, column: str, centres: list[list[float]], decay: float, label: str, path: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """``cluster``, ``centre`` and ``weight`` after every available micro-batch; restarts as in ``stream_state``."""
    spark = stream.sparkSession

    def rows(centres: list[list[float]], weights: list[float]) -> DataFrame:
        return spark.createDataFrame([(i, [float(v) for v in c], float(w)) for i, (c, w) in enumerate(zip(centres, weights))], _CENTRES)

    def step(batch: DataFrame, before: list[Row]) -> DataFrame:
        ordered = sorted(before, key=lambda r: r["cluster"])
        return rows(*update_centres(batch, column, [r["centre"] for r in ordered], [r["weight"] for r in ordered], decay))

    return stream_state(stream, rows(centres, [0.0] * len(centres)), step, label, path, checkpoint)


def stream_regression(
    stream: DataFrame, features: Sequence[str], label: str, rate: float, steps: int, name: str, logistic: bool = False,
    path: str | None = None, checkpoint: str | None = None,
) -> DataFrame:
    """``place``, ``feature`` and ``weight`` of a linear or logistic model moved by gradient steps over every micro-batch.

    A batch without rows leaves them as they are; restarts as in ``stream_state``.
    """
    names = list(features)
    spark = stream.sparkSession

    def rows(weights: list[float]) -> DataFrame:
        return spark.createDataFrame([(i, n, float(w)) for i, (n, w) in enumerate(zip(["intercept", *names], weights))], "place int, feature string, weight double")

    def step(batch: DataFrame, before: list[Row]) -> DataFrame:
        weights = [r["weight"] for r in sorted(before, key=lambda r: r["place"])]
        data = batch.select(*[F.col(c).cast("double").alias(c) for c in names], F.col(label).cast("double").alias("__y"))
        for _ in range(steps):
            score = sum((F.col(c) * v for c, v in zip(names, weights[1:])), F.lit(weights[0]))
            gap = (1.0 / (1.0 + F.exp(-score)) if logistic else score) - F.col("__y")
            row = data.agg(F.avg(gap).alias("g0"), *[F.avg(gap * F.col(c)).alias(f"g{i + 1}") for i, c in enumerate(names)]).first()
            if row["g0"] is None:
                break
            weights = [v - rate * row[f"g{i}"] for i, v in enumerate(weights)]
        return rows(weights)

    return stream_state(stream, rows([0.0] * (len(names) + 1)), step, name, path, checkpoint)


def seeds(df: DataFrame, column: str, order: str, k: int) -> list[list[float]]:
    """First ``k`` vectors in key order (bounded by k)."""
    return [[float(v) for v in r[column]] for r in df.orderBy(order).limit(k).select(column).collect()]
