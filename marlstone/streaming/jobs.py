"""Streaming jobs; each takes a streaming DataFrame and returns another one.

The same functions work on batch DataFrames, which is how results are checked.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import scratch_path
from .runner import run_batches


def word_counts(lines: DataFrame, text: str) -> DataFrame:
    words = lines.select(F.explode(F.split(F.col(text), " ")).alias("word")).filter("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def window_counts(df: DataFrame, time: str, keys: Sequence[str], length: str, slide: str | None = None) -> DataFrame:
    return df.groupBy(F.window(time, length, slide or length), *keys).agg(F.count(F.lit(1)).alias("n"))


def window_reduce(df: DataFrame, time: str, keys: Sequence[str], length: str, slide: str, value: str) -> DataFrame:
    """Sum, extremes and count per window; windows are aggregated, so no inverse is needed."""
    return df.groupBy(F.window(time, length, slide), *keys).agg(
        F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n")
    )


def sessions(df: DataFrame, time: str, keys: Sequence[str], gap: str) -> DataFrame:
    """Sessions closed by silence: number of events and duration in seconds.

    ``build_session`` has sessions merged inside every partition before the
    shuffle, so a busy key sends its sessions and not its events.
    """
    grouped = df.groupBy(F.session_window(time, gap), *keys).agg(
        F.count(F.lit(1)).alias("events"), F.min(time).alias("__first"), F.max(time).alias("__last")
    )
    seconds = F.unix_micros("__last") - F.unix_micros("__first")
    return grouped.select("session_window", *keys, "events", (seconds / 1e6).alias("duration"))


def running_totals(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias("total"))


def with_initial(totals: DataFrame, initial: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals on top of the state the stream started from."""
    both = totals.select(*keys, "total").unionByName(initial.select(*keys, "total"))
    return both.groupBy(*keys).agg(F.sum("total").alias("total"))


def error_rate(df: DataFrame, time: str, keys: Sequence[str], length: str, bad: Column, limit: float) -> DataFrame:
    """Share of bad events per window and whether it is above the limit."""
    rate = F.avg(bad.cast("double"))
    return df.groupBy(F.window(time, length), *keys).agg(rate.alias("error_rate"), (rate > limit).alias("alarm"))


def distinct_in_window(df: DataFrame, time: str, who: str, length: str) -> DataFrame:
    """Each (window, user) once; counting the rows gives the exact number of users."""
    seen = df.select(F.window(time, length).alias("window"), who)
    return seen.dropDuplicates(["window", who])


def approx_users(df: DataFrame, time: str, who: str, length: str) -> DataFrame:
    return df.groupBy(F.window(time, length)).agg(F.approx_count_distinct(who).alias("users"))


def enrich(df: DataFrame, static: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    return df.join(static, list(on), how)


def sentiment(words: DataFrame, scores: DataFrame) -> DataFrame:
    """Frequency times score per word."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(scores, "word").select("word", (F.col("n") * F.col("score")).alias("sentiment"))


def sql_per_batch(stream: DataFrame, view: str, text: str, path: str, label: str) -> None:
    """Run an SQL text over every micro-batch and keep its result by batch."""

    def each(batch: DataFrame, number: int) -> None:
        batch.createOrReplaceTempView(view)
        batch.sparkSession.sql(text).write.mode("overwrite").parquet(f"{path}/batch={number}")

    run_batches(stream, each, label)


def join_within(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, seconds: int, how: str = "inner"
) -> DataFrame:
    """Join two streams on a key where the right event follows within ``seconds``.

    Both sides are also cut into time slices of that length, so one busy key is
    spread over its slices.  One side has to stand in two slices to meet the
    other.  Outer rows come from the side that stands in one: a row that is
    doubled could be matched in one slice and not in the other.  So right rows
    are doubled (their own slice and the one before), for ``right_outer`` left
    rows (their own and the next); ``full_outer`` is the left join, and of the
    right join what has no left row.  An outer row comes out once, when the
    watermark has passed all that could match it.

    The result has the columns of both sides, of which names may clash: for
    ``full_outer`` they must not, but for ``key``, which comes as that of
    whichever side there is.
    """
    if how not in ("inner", "left_outer", "right_outer", "full_outer"):
        raise ValueError(f"unknown way to join within a time: {how}")
    if how == "full_outer":
        return _full_within(left, right, key, left_time, right_time, seconds)

    def slice_of(time: str) -> Column:
        return F.floor(F.unix_seconds(F.col(time)) / seconds)

    def sliced(df: DataFrame, time: str, other: int) -> DataFrame:
        own = slice_of(time)
        return df.withColumn("__slice", F.explode(F.array(own, own + other)) if other else own)

    l = sliced(left, left_time, 1 if how == "right_outer" else 0).alias("l")  # noqa: E741
    r = sliced(right, right_time, 0 if how == "right_outer" else -1).alias("r")
    bound = F.expr(f"interval {seconds} seconds")
    match = (
        (F.col(f"l.{key}") == F.col(f"r.{key}"))
        & (F.col("l.__slice") == F.col("r.__slice"))
        & (F.col(f"r.{right_time}") >= F.col(f"l.{left_time}"))
        & (F.col(f"r.{right_time}") <= F.col(f"l.{left_time}") + bound)
    )
    return l.join(r, match, how)


def _full_within(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, seconds: int) -> DataFrame:
    """All rows of both sides: the left join, and the right rows of the right join that met nobody."""
    names = [c for c in left.columns if c != key] + [c for c in right.columns if c != key]
    if len(set(names)) < len(names):
        raise ValueError("a full join takes columns of different names")

    def kept(how: str) -> DataFrame:
        return join_within(left, right, key, left_time, right_time, seconds, how)

    whose = lambda side, columns: [F.col(f"{side}.{c}") for c in columns if c != key]
    all_left = kept("left_outer").select(F.col(f"l.{key}").alias(key), *whose("l", left.columns), *whose("r", right.columns))
    met_nobody = kept("right_outer").where(F.col(f"l.{key}").isNull())
    only_right = met_nobody.select(F.col(f"r.{key}").alias(key), *whose("l", left.columns), *whose("r", right.columns))
    return all_left.union(only_right)


def session_updates(df: DataFrame, time: str, key: str, gap: int, delay: str) -> DataFrame:
    """Every change of a key's session, and a last row with ``expired`` when it closes.

    Events of one key less than a gap apart are combined before the shuffle, so
    a busy key sends one row per gap and batch.
    """
    schema = f"{key} long, first timestamp, last timestamp, events long"

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            place = pdf[time].astype("int64") // (gap * 1_000_000_000 // _unit(pdf[time]))
            grouped = pdf.groupby([pdf[key], place])[time].agg(["min", "max", "count"])
            yield grouped.reset_index(level=0).rename(columns={"min": "first", "max": "last", "count": "events"})

    def advance(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []

        def row(first: pd.Timestamp, last: pd.Timestamp, events: int, expired: bool) -> None:
            out.append((keys[0], events, (last.value - first.value) // 1000 / 1e6, expired))

        if state.hasTimedOut:
            first, last, events = state.get
            row(pd.Timestamp(first, unit="us"), pd.Timestamp(last, unit="us"), events, True)
            state.remove()
        else:
            pieces = [(r.first, r.last, r.events) for pdf in batches for r in pdf.itertuples(index=False)]
            if state.exists:
                first, last, events = state.get
                pieces.append((pd.Timestamp(first, unit="us"), pd.Timestamp(last, unit="us"), events))
            merged: list[list] = []
            for first, last, events in sorted(pieces):
                if merged and (first - merged[-1][1]).total_seconds() < gap:
                    merged[-1][1] = max(merged[-1][1], last)
                    merged[-1][2] += events
                else:
                    merged.append([first, last, events])
            for first, last, events in merged[:-1]:
                row(first, last, events, True)
            first, last, events = merged[-1]
            row(first, last, events, False)
            state.update((first.value // 1000, last.value // 1000, events))
            ends = last.value // 1_000_000 + gap * 1000
            state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=[key, "events", "duration", "expired"])

    combined = df.select(key, time).mapInPandas(combine, schema).withWatermark("last", delay)
    return combined.groupBy(key).applyInPandasWithState(
        advance,
        f"{key} long, events long, duration double, expired boolean",
        "first long, last long, events long",
        "update",
        GroupStateTimeout.EventTimeTimeout,
    )


def _unit(column: pd.Series) -> int:
    """Nanoseconds per tick of a datetime column."""
    return {"ns": 1, "us": 1000, "ms": 1_000_000, "s": 1_000_000_000}[getattr(column.dt, "unit", "ns")]


def label_statistics(df: DataFrame, label: str, value: str) -> DataFrame:
    return df.groupBy(label).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance")
    )


def welch(stats: DataFrame, label: str, first: str, second: str, counts: bool = False) -> DataFrame:
    """Welch's t and its degrees of freedom out of two rows of statistics; with ``counts``, also how many rows each has."""

    def of(name: str, wanted: str) -> Column:
        return F.max(F.when(F.col(label) == wanted, F.col(name)))

    row = stats.agg(
        *[of(c, w).alias(f"{c}_{i}") for i, w in enumerate((first, second)) for c in ("n", "mean", "variance")]
    )
    a, b = F.col("variance_0") / F.col("n_0"), F.col("variance_1") / F.col("n_1")
    squares = F.try_divide(F.pow(a, 2), F.col("n_0") - 1) + F.try_divide(F.pow(b, 2), F.col("n_1") - 1)
    freedom = F.try_divide(F.pow(a + b, 2), squares)
    t = F.try_divide(F.col("mean_0") - F.col("mean_1"), F.sqrt(a + b))
    more = [F.coalesce("n_0", F.lit(0)).alias("n_first"), F.coalesce("n_1", F.lit(0)).alias("n_second")] if counts else []
    return row.select(t.alias("t_statistic"), freedom.alias("freedom"), *more)


def batch_statistics(df: DataFrame, label: str, value: str) -> DataFrame:
    """Count, mean and sum of squared differences from it, per label."""
    return df.groupBy(label).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("squares")
    )


def merged_statistics(parts: DataFrame, label: str) -> DataFrame:
    """``label_statistics`` of all rows from the statistics of parts of them.

    The squares of a part count from its own mean; they are moved to that of
    all, so nothing large is taken from something as large.
    """
    known = parts.where("n > 0")
    means = known.groupBy(label).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("__mean"))
    moved = F.col("squares") + F.col("n") * F.pow(F.col("mean") - F.col("__mean"), 2)
    return known.join(means, label).groupBy(label).agg(
        F.sum("n").alias("n"), F.first("__mean").alias("mean"), F.sum(moved).alias("squares")
    ).select(label, "n", "mean", F.try_divide(F.col("squares"), F.col("n") - 1).alias("variance"))


def ab_test(
    stream: DataFrame, label: str, value: str, first: str, second: str, peace: int, window: int, name: str,
    path: str | None = None, checkpoint: str | None = None,
) -> DataFrame:
    """Welch's test of two labels after every micro-batch: ``batch``, ``t_statistic``, ``freedom``, ``n_first``, ``n_second``.

    The first ``peace`` batches are left alone.  A test takes the last
    ``window`` batches after those, all of them with ``window`` 0.  A batch
    with too few rows of a label gives nulls.

    Every batch leaves a few numbers per label in a folder of its own, and a
    test merges those of its window: a ring of ``window`` of them is read, not
    the events again.  With ``window`` 0 what is read is the batch's and the
    merged numbers of the batch before.  A batch that is repeated overwrites
    its own folder and reads the same others, so a restart with the same
    ``path`` and ``checkpoint`` goes on as if nothing had happened.
    """
    if peace < 0 or window < 0:
        raise ValueError("batches are counted from zero")
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)
    schema = f"{label} {stream.schema[label].dataType.simpleString()}, n long, mean double, squares double"

    def merged(parts: DataFrame) -> DataFrame:
        whole = merged_statistics(parts, label)
        return whole.select(label, "n", "mean", F.coalesce(F.col("variance") * (F.col("n") - 1), F.lit(0.0)).alias("squares"))

    def each(batch: DataFrame, number: int) -> None:
        own = f"{path}/numbers/batch={number}"
        batch_statistics(batch, label, value).coalesce(1).write.mode("overwrite").parquet(own)
        if number < peace:
            return
        if window:
            asked = [f"{path}/numbers/batch={k}" for k in range(max(peace, number - window + 1), number + 1)]
        else:
            asked = [own, *([f"{path}/sums/batch={number - 1}"] if number > peace else [])]
        parts = spark.read.schema(schema).parquet(*asked)
        if not window:
            merged(parts).coalesce(1).write.mode("overwrite").parquet(f"{path}/sums/batch={number}")
        tested = welch(merged_statistics(parts, label), label, first, second, counts=True)
        tested.write.mode("overwrite").parquet(f"{path}/tests/batch={number}")

    run_batches(stream, each, name, checkpoint=checkpoint)
    tests = spark.read.schema("t_statistic double, freedom double, n_first long, n_second long, batch long")
    return tests.parquet(f"{path}/tests")


def matching_lines(streams: Sequence[DataFrame], column: str, token: str) -> DataFrame:
    """Count of lines holding a token over several inputs."""
    out = streams[0].select(column)
    for s in streams[1:]:
        out = out.unionByName(s.select(column))
    return out.filter(F.col(column).contains(token)).groupBy(F.lit(token).alias("token")).agg(F.count(F.lit(1)).alias("lines"))
