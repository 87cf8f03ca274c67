"""Ordered calculations that do not put one key's rows in one task.

A plain ``Window.partitionBy(key)`` sends a key's rows to a single task, so a
key that owns a third of a large table becomes the whole job.  Here the order
value is cut into chunks, each (key, chunk) is worked on separately, and the
small per-chunk totals carry results from one chunk to the next:

* ``running``  - cumulative sums, ranks and fills: prefix of the chunk totals
  plus the value inside the chunk;
* ``blocked``  - frames of a fixed number of rows (rolling, lag, lead): blocks
  of consecutive positions, each extended by the neighbour rows it needs.

Both are exact.  The split points come from one pass over the order column;
ties of the leading order column always share a chunk, which keeps ranks
right, unless the value fills several chunks by itself.

The number of chunks follows the counted rows (``CHUNK_ROWS`` each).  Rows of
one chunk carry nothing on and are a plain window's.  A caller who knows that no
key is large may ask for the plain window with ``small=True``; the answers,
and their types, are the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a chunk should hold.
CHUNK_ROWS = 1_000_000
#: Texts drawn per chunk to find split points among real values.
SAMPLES = 20

CHUNK = "__chunk"
POSITION = "__position"
BLOCK = "__block"
OWN = "__own"

Order = Sequence[tuple[str, bool]]


def order_value(df: DataFrame, name: str) -> Column:
    """What split points are looked for in: a number that sorts like the column, or its text."""
    dtype = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(dtype, T.StringType):
        return col
    return col.cast("double")


def split_points(df: DataFrame, name: str, chunks: int | None = None) -> list:
    """Cut points of the order column ``name``, sorted; a heavy value comes several times.

    The number of chunks follows from the counted rows alone; for one chunk
    there is nothing to cut.  Otherwise quantiles are sketched.  Texts are cut
    at texts drawn at random, so long common beginnings do no harm; where the
    cuts lie never changes a result.
    """
    return _points(df, name, chunks).get(None, [])


def _points(df: DataFrame, name: str, chunks: int | None, by: Column | None = None, wanted: dict | None = None) -> dict:
    """Cut points per value of ``by`` (one pass for all), ``wanted`` chunks each."""
    value = order_value(df, name)
    if by is None:
        rows = df.count() if chunks is None or isinstance(df.schema[name].dataType, T.StringType) else 0
        wanted, by = {None: chunks or -(-rows // CHUNK_ROWS)}, F.lit(None).cast("string")
    most = max(wanted.values(), default=0)
    if most <= 1:
        return {}
    if isinstance(df.schema[name].dataType, T.StringType):
        rows = df.count() if None not in wanted else rows
        share = min(1.0, SAMPLES * sum(wanted.values()) / max(1, rows))
        drawn: dict = {}
        for key, v in df.select(by.alias("k"), value.alias("v")).sample(share, 17).collect():
            if v is not None:
                drawn.setdefault(key, []).append(v)
        found = {k: sorted(v) for k, v in drawn.items()}
    else:
        fractions = [i / most for i in range(1, most)]
        sketch = F.percentile_approx(value, fractions, max(10_000, 10 * most))
        found = {r["k"]: sorted(r["cuts"] or []) for r in df.groupBy(by.alias("k")).agg(sketch.alias("cuts")).collect()}
    return {k: [v[len(v) * i // wanted[k]] for i in range(1, wanted[k])] for k, v in found.items() if v and k in wanted}


def _descend(value: Column, cuts: Sequence, low: int, high: int, leaf) -> Column:
    """Balanced tree of comparisons (stays in generated code)."""
    if low == high:
        return leaf(low)
    middle = (low + high) // 2
    return F.when(value <= F.lit(cuts[middle]), _descend(value, cuts, low, middle, leaf)).otherwise(
        _descend(value, cuts, middle + 1, high, leaf)
    )


def with_chunks(df: DataFrame, order: Order, chunks: int | None = None, points: list | None = None) -> DataFrame:
    """Add the chunk number of every row; chunks follow the order.

    A value of the leading column that fills several chunks by itself is cut
    again by the second order column.
    """
    name, ascending = order[0]
    value = order_value(df, name)
    listed = split_points(df, name, chunks) if points is None else points
    cuts = sorted(set(listed))
    heavy = {c: listed.count(c) for c in cuts if listed.count(c) > 1} if len(order) > 1 else {}
    # One pass for all heavy values together.
    found = _points(df.filter(value.isin([F.lit(h) for h in heavy])), order[1][0], None, value, heavy) if heavy else {}
    inner: dict = {h: sorted(set(found.get(h, []))) for h in heavy}
    # every value range gets a block of numbers: the range below a cut, then the cut itself when heavy
    width = 1 + max([len(v) + 2 for v in inner.values()], default=0)

    def leaf(i: int) -> Column:
        start = 1 + i * width
        if i < len(cuts) and cuts[i] in inner:
            inside = _second_chunk(order[1], order_value(df, order[1][0]), inner[cuts[i]])
            own = F.lit(start + 1) + inside
            below = F.lit(start)
            if not ascending:
                # numbers are negated below, so the inner order is turned around first
                own = F.lit(start + width - 1) - inside
            return F.when(value == F.lit(cuts[i]), own).otherwise(below)
        return F.lit(start)

    # A single chunk must not become a constant: joins on it would lose their key.
    chosen = _descend(value, cuts, 0, len(cuts), leaf) if cuts else F.pmod(F.xxhash64(value), F.lit(1)).cast("int") + 1
    number = F.when(value.isNull(), F.lit(0)).otherwise(chosen)
    return df.withColumn(CHUNK, number if ascending else -number)


def _second_chunk(order: tuple[str, bool], value: Column, cuts: Sequence) -> Column:
    """0 .. len(cuts)+1 in the direction of the second column."""
    rising = F.when(value.isNull(), F.lit(0)).otherwise(_descend(value, cuts, 0, len(cuts), lambda i: F.lit(i + 1)))
    return rising if order[1] else F.lit(len(cuts) + 1) - rising


def sort_columns(order: Order) -> list[Column]:
    return [F.col(f"`{n}`").asc_nulls_first() if up else F.col(f"`{n}`").desc_nulls_last() for n, up in order]


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match each other; the right keys are dropped."""
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"__r_{c}") if c in on else F.col(f"`{c}`") for c in right.columns]
    )
    condition = reduce(
        lambda a, b: a & b,
        [F.col(f"`{c}`").eqNullSafe(F.col(f"`__r_{c}`")) for c in on],
    )
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])


@dataclass(frozen=True)
class Running:
    """One running result: ``kind`` over ``column`` (``n`` for ntile)."""

    kind: str
    column: str | None = None
    n: int = 0


def _plain(spec: Running, window) -> Column:
    """The same result over one window per key."""
    c = F.col(f"`{spec.column}`") if spec.column else None
    to_here = window.rowsBetween(Window.unboundedPreceding, 0)
    ranks = {
        "row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank, "percent_rank": F.percent_rank,
        "cume_dist": F.cume_dist,
    }
    if spec.kind in ranks:
        value = ranks[spec.kind]().over(window)
        return value if spec.kind in ("percent_rank", "cume_dist") else value.cast("long")
    if spec.kind == "ntile":
        return F.ntile(spec.n).over(window).cast("long")
    if spec.kind == "count":
        return F.count(c if c is not None else F.lit(1)).over(to_here)
    if spec.kind == "fill_forward":
        return F.last(c, ignorenulls=True).over(to_here)
    if spec.kind == "first_value":
        return F.first(c).over(to_here)
    if spec.kind in ("sum", "avg", "min", "max", "product"):
        return getattr(F, spec.kind)(c).over(to_here)
    raise ValueError(f"unknown running result {spec.kind}")


_PEER_RANKS = {"rank", "dense_rank", "percent_rank", "cume_dist"}


def _peer_ranks(df: DataFrame, keys: list[str], order: Order, results: dict[str, Running], chunks: int | None) -> DataFrame:
    """Ranks that are equal for equal order values: computed once per value and joined back.

    However many rows share one value, it is a single row here.
    """
    names = [n for n, _ in order]
    values = df.groupBy(*[F.col(f"`{n}`") for n in dict.fromkeys([*keys, *names])]).agg(F.count(F.lit(1)).alias("__copies"))
    placed = running(
        values, keys, order, {"__upto": Running("sum", "__copies"), "__dense": Running("row_number")}, chunks
    )
    sizes = values.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.sum("__copies").alias("__size"))
    placed = null_safe_join(placed, sizes, keys) if keys else placed.withColumn("__size", sizes.scalar())
    rank = F.col("__upto") - F.col("__copies") + 1
    size = F.col("__size")
    ways = {
        "rank": rank,
        "dense_rank": F.col("__dense"),
        "percent_rank": F.when(size > 1, (rank - 1).cast("double") / (size - 1)).otherwise(F.lit(0.0)),
        "cume_dist": F.col("__upto").cast("double") / size,
    }
    on = list(dict.fromkeys([*keys, *names]))
    ranked = placed.select(*[F.col(f"`{n}`") for n in on], *[ways[spec.kind].alias(out) for out, spec in results.items()])
    return null_safe_join(df.drop(*results), ranked, on, "inner")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    results: dict[str, Running],
    chunks: int | None = None,
    small: bool = False,
) -> DataFrame:
    """Add running results per ``keys`` in ``order``; safe for a hot key.

    With ``small`` the caller answers for it that no key is large.  Rows of one
    chunk in all carry nothing on, so a window over each key is the same.
    """
    keys = list(keys)
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*sort_columns(order))
    points = None if small else split_points(df, order[0][0], chunks)
    if small or not points and chunks is None:
        added = {out: _plain(spec, window) for out, spec in results.items()}
        kept = [F.col(f"`{c}`") for c in df.columns if c not in results]
        return df.select(*kept, *[c.alias(out) for out, c in added.items()])
    peers_only = {out: spec for out, spec in results.items() if spec.kind in _PEER_RANKS}
    if peers_only:
        df = _peer_ranks(df, keys, order, peers_only, chunks)
        results = {out: spec for out, spec in results.items() if out not in peers_only}
        if not results:
            return df
    base = with_chunks(df, order, chunks, points if not peers_only else None)
    sort = sort_columns(order)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*sort)
    plain_types = df.select(*[_plain(spec, window).alias(out) for out, spec in results.items()]).schema
    to_here = inside.rowsBetween(Window.unboundedPreceding, 0)

    partials: dict[str, Column] = {"__n": F.count(F.lit(1))}
    for out, spec in results.items():
        c = F.col(f"`{spec.column}`") if spec.column else None
        if spec.kind in ("sum", "avg"):
            partials[f"__sum_{out}"] = F.sum(c)
            partials[f"__cnt_{out}"] = F.count(c)
        elif spec.kind == "count":
            partials[f"__cnt_{out}"] = F.count(c if c is not None else F.lit(1))
        elif spec.kind in ("min", "max"):
            partials[f"__{spec.kind}_{out}"] = getattr(F, spec.kind)(c)
        elif spec.kind == "product":
            partials[f"__prod_{out}"] = F.product(c)
        elif spec.kind in ("fill_forward", "first_value"):
            # the place in the chunk follows the order, whatever its direction
            place = F.col("__place")
            picked = F.struct(c.alias("v"))
            if spec.kind == "fill_forward":
                partials[f"__fill_{out}"] = F.max_by(picked, F.when(c.isNotNull(), place))
            else:
                partials[f"__first_{out}"] = F.min_by(picked, place)
        elif spec.kind not in ("row_number", "ntile"):
            raise ValueError(f"unknown running result {spec.kind}")

    if any(spec.kind in ("fill_forward", "first_value") for spec in results.values()):
        placed = base.withColumn("__place", F.row_number().over(inside))
    else:
        placed = base
    totals = placed.groupBy(*keys, CHUNK).agg(*[v.alias(k) for k, v in partials.items()])
    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = by_key.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    prefix = [F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__rows_before")]
    prefix.append(F.sum("__n").over(by_key).alias("__rows_total"))
    for name in partials:
        if name == "__n":
            continue
        source = F.col(f"`{name}`")
        if name.startswith(("__sum_", "__cnt_")):
            prefix.append(F.sum(source).over(before).alias(name))
        elif name.startswith("__min_"):
            prefix.append(F.min(source).over(before).alias(name))
        elif name.startswith("__max_"):
            prefix.append(F.max(source).over(before).alias(name))
        elif name.startswith("__prod_"):
            prefix.append(F.product(source).over(before).alias(name))
        elif name.startswith("__fill_"):
            prefix.append(F.last(source, ignorenulls=True).over(before).getField("v").alias(name))
        elif name.startswith("__first_"):
            prefix.append(F.first(source).over(before).alias(name))
    carried = totals.select(*[F.col(f"`{k}`") for k in keys], CHUNK, *prefix)
    joined = null_safe_join(base, carried, [*keys, CHUNK])

    zero = F.lit(0)
    added = []
    for out, spec in results.items():
        c = F.col(f"`{spec.column}`") if spec.column else None
        rows_before = F.col("__rows_before")
        if spec.kind == "row_number":
            value = rows_before + F.row_number().over(inside)
        elif spec.kind == "ntile":
            place = rows_before + F.row_number().over(inside)
            small = F.floor(F.col("__rows_total") / spec.n)
            extra = F.col("__rows_total") % spec.n
            cut = extra * (small + 1)
            value = F.when(place <= cut, F.floor((place - 1) / (small + 1)) + 1).otherwise(
                extra + F.floor((place - cut - 1) / F.greatest(small, F.lit(1))) + 1
            )
        elif spec.kind in ("sum", "avg"):
            inner_n = F.coalesce(F.col(f"`__cnt_{out}`"), zero) + F.count(c).over(to_here)
            inner = F.coalesce(F.col(f"`__sum_{out}`"), zero) + F.coalesce(F.sum(c).over(to_here), zero)
            inner = F.when(inner_n > 0, inner)
            held = df.schema[spec.column].dataType
            if isinstance(held, T.DecimalType):  # as wide as the sum of one window, so that the mean is rounded once
                inner = inner.cast(T.DecimalType(min(38, held.precision + 10), held.scale))
                inner_n = inner_n.cast("decimal(20,0)")
            value = inner if spec.kind == "sum" else F.try_divide(inner, inner_n)
        elif spec.kind == "count":
            value = F.coalesce(F.col(f"`__cnt_{out}`"), zero) + F.count(c if c is not None else F.lit(1)).over(to_here)
        elif spec.kind == "min":
            value = F.least(F.col(f"`__min_{out}`"), F.min(c).over(to_here))
        elif spec.kind == "max":
            value = F.greatest(F.col(f"`__max_{out}`"), F.max(c).over(to_here))
        elif spec.kind == "product":
            value = F.coalesce(F.col(f"`__prod_{out}`"), F.lit(1.0)) * F.product(c).over(to_here)
        elif spec.kind == "fill_forward":
            value = F.coalesce(F.last(c, ignorenulls=True).over(to_here), F.col(f"`__fill_{out}`"))
        else:
            earlier = F.col(f"`__first_{out}`")
            value = F.when(rows_before > 0, earlier.getField("v")).otherwise(F.first(c).over(to_here))
        added.append(value.cast(plain_types[out].dataType).alias(out))
    keep = [F.col(f"`{c}`") for c in df.columns if c not in results]
    return joined.select(*keep, *added)


def blocked(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    before: int,
    after: int = 0,
    block_rows: int = 1_000_000,
    chunks: int | None = None,
) -> tuple[DataFrame, Window]:
    """Blocks of consecutive rows, each with the neighbour rows its frames need.

    Returns the extended rows and a window over one block.  Apply any
    ``rowsBetween(-before, after)`` expression, then keep rows where ``OWN``.
    """
    size = max(block_rows, before, after, 1)
    placed = running(df, keys, order, {POSITION: Running("row_number")}, chunks)
    index = F.floor((F.col(POSITION) - 1) / size)
    offset = (F.col(POSITION) - 1) % size
    home = F.struct(index.alias("b"), F.lit(True).alias("own"))
    following = F.when(offset >= size - before, F.struct((index + 1).alias("b"), F.lit(False).alias("own")))
    preceding = F.when(
        (offset < after) & (index > 0), F.struct((index - 1).alias("b"), F.lit(False).alias("own"))
    )
    copies = F.filter(F.array(home, following, preceding), lambda s: s.isNotNull())
    spread = placed.withColumn("__copy", F.explode(copies)).select(
        *placed.columns, F.col("__copy.b").alias(BLOCK), F.col("__copy.own").alias(OWN)
    )
    window = Window.partitionBy(*keys, BLOCK).orderBy(POSITION)
    return spread, window


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    make: dict,
    before: int,
    after: int = 0,
    block_rows: int = 1_000_000,
    chunks: int | None = None,
    position: str | None = None,
    small: bool = False,
) -> DataFrame:
    """Add ``make[name](window)`` columns block by block; ``position`` keeps the row number."""
    if small or chunks is None and not split_points(df, order[0][0]):
        plain = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*sort_columns(order))
        added = [build(plain).alias(name) for name, build in make.items()]
        if position:
            added.append(F.row_number().over(plain).cast("long").alias(position))
        return df.select("*", *added)
    spread, window = blocked(df, keys, order, before, after, block_rows, chunks)
    out = spread.select("*", *[build(window).alias(name) for name, build in make.items()])
    out = out.filter(F.col(OWN))
    return (out.withColumnRenamed(POSITION, position) if position else out.drop(POSITION)).drop(BLOCK, OWN)
