"""Streaming jobs run to the end of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import jobs, runner
from .registry import Tables, query


def events(t: Tables, delay: str | None = None) -> DataFrame:
    return runner.event_time(runner.stream_files(t.spark, t.path("events")), "ts", delay)


def landed_events(t: Tables, files: int = 4) -> str:
    return runner.land(t("events"), "ts", files, "landing")


@query(
    "landing_incremental",
    "SELECT event_id, event_type, value FROM events",
)
def landing_incremental(t: Tables) -> DataFrame:
    """JSON files land day by day; running twice over them adds nothing."""
    landing, out, checkpoint = (scratch_path(t.spark, x) for x in ("bronze", "silver", "checkpoint"))
    src = t("events").select("event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    src.write.partitionBy("day").json(landing)
    schema = "event_id bigint, event_type string, value double"
    for _ in range(2):
        stream = t.spark.readStream.schema(schema).option("recursiveFileLookup", True).json(landing)
        runner.run_append(stream, "silver", out, checkpoint)
    return t.spark.read.schema(schema).parquet(out)


@query(
    "stream_word_count",
    "SELECT word, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1",
)
def stream_word_count(t: Tables) -> DataFrame:
    lines = runner.stream_files(t.spark, t.path("documents")).select("text")
    return runner.run_update(jobs.word_counts(lines, "text"), ["word"], "words")


@query(
    "stream_window_count",
    """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS "end", event_type,
      count(*)::BIGINT AS n FROM events GROUP BY 1, 2, 3
    """,
)
def stream_window_count(t: Tables) -> DataFrame:
    stream = jobs.window_counts(events(t, "1 hour"), "ts", ["event_type"], "1 hour")
    return runner.wall_window(runner.run_update(stream, ["window", "event_type"], "windows"))


@query(
    "stream_sessions",
    """
    WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS first
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT user_id, ts, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM o),
    g AS (SELECT user_id, id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*)::BIGINT AS events,
            (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration FROM s GROUP BY 1, 2)
    SELECT start, "end", user_id, events, duration FROM g
    WHERE "end" <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)
    """,
)
def stream_sessions(t: Tables) -> DataFrame:
    """Sessions closed by six silent hours, as the watermark releases them."""
    stream = jobs.sessions(events(t, "1 hour"), "ts", ["user_id"], "6 hours")
    out = t.spark.read.parquet(runner.run_append(stream, "sessions"))
    return runner.wall_window(out)


@query(
    "stream_session_updates",
    """
    WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS first
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT user_id, ts, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM o),
    g AS (SELECT user_id, id, max(id) OVER (PARTITION BY user_id) AS top, min(ts) AS a, max(ts) AS b, count(*)::BIGINT AS events FROM s GROUP BY 1, 2)
    SELECT user_id, events, (epoch_us(b) - epoch_us(a)) / 1e6 AS duration FROM g
    WHERE id < top OR b + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)
    """,
)
def stream_session_updates(t: Tables) -> DataFrame:
    """Sessions as a stateful operator reports them; the closed ones are kept."""
    path = scratch_path(t.spark, "session-updates")
    updates = jobs.session_updates(events(t), "ts", "user_id", 6 * 3600, "1 hour")

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    runner.run_batches(updates, each, "session-updates", "update")
    closed = t.spark.read.parquet(path).filter("expired")
    return closed.select("user_id", "events", "duration")


@query(
    "stream_state_by_key",
    "SELECT user_id, (sum(event_id % 10) + 100)::BIGINT AS total FROM events GROUP BY 1",
)
def stream_state_by_key(t: Tables) -> DataFrame:
    totals = runner.run_update(jobs.running_totals(events(t), ["user_id"], F.col("event_id") % 10), ["user_id"], "state")
    initial = t("events").select("user_id").distinct().withColumn("total", F.lit(100).cast("long"))
    return jobs.with_initial(totals, initial, ["user_id"])


@query(
    "stream_sliding_value_counts",
    """
    WITH s AS (SELECT event_type, ts, unnest(range(4)) AS k FROM events)
    SELECT time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS start,
      time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE + INTERVAL 1 HOUR AS "end", event_type, count(*)::BIGINT AS n
    FROM s GROUP BY 1, 2, 3
    """,
)
def stream_sliding_value_counts(t: Tables) -> DataFrame:
    stream = jobs.window_counts(events(t, "1 hour"), "ts", ["event_type"], "1 hour", "15 minutes")
    return runner.wall_window(runner.run_update(stream, ["window", "event_type"], "sliding"))


@query(
    "stream_error_rate",
    """
    SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS "end", (user_id % 5)::BIGINT AS zip,
      round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 8) AS error_rate,
      avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) > 0.05 AS alarm FROM events GROUP BY 1, 2, 3
    """,
)
def stream_error_rate(t: Tables) -> DataFrame:
    src = events(t, "1 hour").withColumn("zip", F.col("user_id") % 5)
    stream = jobs.error_rate(src, "ts", ["zip"], "6 hours", F.col("event_type") == "error", 0.05)
    out = runner.wall_window(runner.run_update(stream, ["window", "zip"], "errors"))
    return out.withColumn("error_rate", F.round("error_rate", 8))


@query(
    "stream_unique_users",
    """
    SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS "end",
      count(DISTINCT user_id)::BIGINT AS users FROM events GROUP BY 1, 2
    """,
)
def stream_unique_users(t: Tables) -> DataFrame:
    stream = jobs.distinct_in_window(events(t, "1 hour"), "ts", "user_id", "6 hours")
    seen = t.spark.read.parquet(runner.run_append(stream, "users"))
    return runner.wall_window(seen.groupBy("window").agg(F.count(F.lit(1)).alias("users")))


@query("stream_unique_users_approx")
def stream_unique_users_approx(t: Tables) -> DataFrame:
    stream = jobs.approx_users(events(t, "1 hour"), "ts", "user_id", "6 hours")
    return runner.wall_window(runner.run_update(stream, ["window"], "approx-users"))


@query(
    "stream_static_join",
    "SELECT event_id, event_type, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey",
)
def stream_static_join(t: Tables) -> DataFrame:
    static = t("customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    stream = jobs.enrich(events(t), static, ["user_id"]).select("event_id", "event_type", "c_mktsegment")
    return t.spark.read.parquet(runner.run_append(stream, "enriched"))


@query(
    "stream_sentiment",
    """
    WITH b AS (SELECT word, count(*) AS score FROM (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark) WHERE word <> '' GROUP BY 1),
    d AS (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1)
    SELECT word, (n * score)::BIGINT AS sentiment FROM d JOIN b USING (word)
    """,
)
def stream_sentiment(t: Tables) -> DataFrame:
    """Word frequency of the stream times the weight of the word in a static table."""
    scores = jobs.word_counts(t("benchmark"), "text").withColumnRenamed("n", "score")
    lines = runner.stream_files(t.spark, t.path("documents")).select("text")
    counts = runner.run_update(jobs.word_counts(lines, "text"), ["word"], "sentiment")
    return counts.join(scores, "word").select("word", (F.col("n") * F.col("score")).alias("sentiment"))


@query(
    "stream_foreach_sql",
    "SELECT event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY 1",
)
def stream_foreach_sql(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "per-batch")
    stream = runner.stream_files(t.spark, landed_events(t), 1)
    jobs.sql_per_batch(
        stream, "marl_batch", "SELECT event_type, count(*) AS n, sum(value) AS total FROM marl_batch GROUP BY event_type", path, "sql"
    )
    per_batch = t.spark.read.parquet(path)
    return per_batch.groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))


@query("stream_recover", "SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def stream_recover(t: Tables) -> DataFrame:
    """The second run continues from the checkpoint of the first."""
    landing, out, checkpoint = (scratch_path(t.spark, x) for x in ("feed", "recovered", "checkpoint"))
    result = None
    for half in (0, 1):
        t("events").filter(F.col("event_id") % 2 == half).write.mode("append").parquet(landing)
        stream = runner.stream_files(t.spark, landing).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        result = runner.run_update(stream, ["event_type"], "recovered", out, checkpoint)
    return result


@query(
    "stream_reduce_window",
    """
    WITH s AS (SELECT event_type, ts, value, unnest(range(2)) AS k FROM events)
    SELECT time_bucket(INTERVAL 3 HOUR, ts) - k * INTERVAL 3 HOUR AS start, time_bucket(INTERVAL 3 HOUR, ts) - k * INTERVAL 3 HOUR + INTERVAL 6 HOUR AS "end",
      event_type, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high, count(*)::BIGINT AS n FROM s GROUP BY 1, 2, 3
    """,
)
def stream_reduce_window(t: Tables) -> DataFrame:
    stream = jobs.window_reduce(events(t, "1 hour"), "ts", ["event_type"], "6 hours", "3 hours", "value")
    out = runner.wall_window(runner.run_update(stream, ["window", "event_type"], "reduced"))
    return out.withColumn("total", F.round("total", 4))


@query("stream_queue", "SELECT count(*)::BIGINT AS n, 4::BIGINT AS batches FROM events")
def stream_queue(t: Tables) -> DataFrame:
    """A queue of files, one per micro-batch."""
    path = scratch_path(t.spark, "queue")
    stream = runner.stream_files(t.spark, landed_events(t, 4), 1)

    def each(batch: DataFrame, number: int) -> None:
        batch.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    runner.run_batches(stream, each, "queue")
    return t.spark.read.parquet(path).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("batches"))


@query(
    "stream_union",
    "SELECT event_type, count(*)::BIGINT AS n FROM (SELECT * FROM events UNION ALL SELECT * FROM events) GROUP BY 1",
)
def stream_union(t: Tables) -> DataFrame:
    both = events(t).unionByName(events(t))
    return runner.run_update(both.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), ["event_type"], "union")


@query(
    "stream_join",
    """
    SELECT v.event_id AS view_id, p.event_id AS purchase_id FROM events v JOIN events p ON v.user_id = p.user_id
      AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 6 HOUR WHERE v.event_type = 'view' AND p.event_type = 'purchase'
    """,
)
def stream_join(t: Tables) -> DataFrame:
    views = events(t, "1 hour").filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"))
    buys = events(t, "1 hour").filter("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    stream = jobs.join_within(views, buys, "user_id", "ts", "ts", 6 * 3600).select("view_id", "purchase_id")
    return t.spark.read.parquet(runner.run_append(stream, "joined"))


@query(
    "stream_join_left",
    """
    SELECT v.event_id AS view_id, p.event_id AS purchase_id FROM (SELECT * FROM events WHERE event_type = 'view') v
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON v.user_id = p.user_id
      AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 6 HOUR
    WHERE p.event_id IS NOT NULL OR v.ts + INTERVAL 6 HOUR <
      (SELECT date_trunc('millisecond', least(max(ts) FILTER (WHERE event_type = 'view'), max(ts) FILTER (WHERE event_type = 'purchase'))) - INTERVAL 1 HOUR FROM events)
    """,
)
def stream_join_left(t: Tables) -> DataFrame:
    """Views without a purchase appear once the watermark has passed their bound."""
    views = events(t).filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id")).withWatermark("ts", "1 hour")
    buys = events(t).filter("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id")).withWatermark("ts", "1 hour")
    stream = jobs.join_within(views, buys, "user_id", "ts", "ts", 6 * 3600, "left_outer").select("view_id", "purchase_id")
    return t.spark.read.parquet(runner.run_append(stream, "joined-left"))


_SIDES = """
    WITH v AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view'), p AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'),
    mark AS (SELECT date_trunc('millisecond', least(max(ts) FILTER (WHERE event_type = 'view'), max(ts) FILTER (WHERE event_type = 'purchase'))) - INTERVAL 1 HOUR AS ts FROM events)
"""


def _views_and_buys(t: Tables) -> tuple[DataFrame, DataFrame]:
    def side(kind: str, name: str, time: str) -> DataFrame:
        return events(t).filter(F.col("event_type") == kind).select("user_id", F.col("ts").alias(time), F.col("event_id").alias(name)).withWatermark(time, "1 hour")

    return side("view", "view_id", "viewed"), side("purchase", "purchase_id", "bought")


@query(
    "stream_join_right",
    _SIDES
    + """
    SELECT v.event_id AS view_id, p.event_id AS purchase_id FROM v RIGHT JOIN p ON v.user_id = p.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 6 HOUR
    WHERE v.event_id IS NOT NULL OR p.ts < (SELECT ts FROM mark)
    """,
)
def stream_join_right(t: Tables) -> DataFrame:
    """Purchases without a view before them appear once, when the watermark has passed them."""
    views, buys = _views_and_buys(t)
    stream = jobs.join_within(views, buys, "user_id", "viewed", "bought", 6 * 3600, "right_outer").select("view_id", "purchase_id")
    return t.spark.read.parquet(runner.run_append(stream, "joined-right"))


@query(
    "stream_join_full",
    _SIDES
    + """
    SELECT coalesce(v.user_id, p.user_id) AS user_id, v.event_id AS view_id, p.event_id AS purchase_id
    FROM v FULL JOIN p ON v.user_id = p.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 6 HOUR
    WHERE v.event_id IS NOT NULL AND p.event_id IS NOT NULL OR p.event_id IS NULL AND v.ts + INTERVAL 6 HOUR < (SELECT ts FROM mark)
      OR v.event_id IS NULL AND p.ts < (SELECT ts FROM mark)
    """,
)
def stream_join_full(t: Tables) -> DataFrame:
    """Views and purchases, each also alone."""
    views, buys = _views_and_buys(t)
    stream = jobs.join_within(views, buys, "user_id", "viewed", "bought", 6 * 3600, "full_outer").select("user_id", "view_id", "purchase_id")
    return t.spark.read.parquet(runner.run_append(stream, "joined-full"))


def _ab_sql(parts: int, peace: int, window: int) -> str:
    first = f"greatest({peace}, b - {window} + 1)" if window else str(peace)
    return f"""
    WITH s AS (SELECT b, event_type, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM events, (SELECT unnest(range({peace}, {parts})) AS b)
      WHERE event_id % {parts} BETWEEN {first} AND b GROUP BY 1, 2)
    SELECT a.b AS batch, round((a.m - c.m) / sqrt(a.v / a.n + c.v / c.n), 6) AS t_statistic,
      round(pow(a.v / a.n + c.v / c.n, 2) / (pow(a.v / a.n, 2) / (a.n - 1) + pow(c.v / c.n, 2) / (c.n - 1)), 3) AS freedom, a.n AS n_first, c.n AS n_second
    FROM s a JOIN s c ON a.b = c.b AND a.event_type = 'click' AND c.event_type = 'view'
    """


def _ab(t: Tables, window: int) -> DataFrame:
    path = runner.land_parts(t("events"), F.col("event_id") % 6, 6, 2, "ab")
    out = jobs.ab_test(runner.stream_files(t.spark, path, 2), "event_type", "value", "click", "view", 1, window, "ab-window")
    return out.select("batch", F.round("t_statistic", 6).alias("t_statistic"), F.round("freedom", 3).alias("freedom"), "n_first", "n_second")


@query("stream_ab_window", _ab_sql(6, 1, 2))
def stream_ab_window(t: Tables) -> DataFrame:
    """A test after every batch but the first, over the last two."""
    return _ab(t, 2)


@query("stream_ab_growing", _ab_sql(6, 1, 0))
def stream_ab_growing(t: Tables) -> DataFrame:
    """A test after every batch but the first, over all since."""
    return _ab(t, 0)


@query(
    "stream_ab_test",
    """
    WITH s AS (SELECT event_type, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM events GROUP BY 1),
    a AS (SELECT * FROM s WHERE event_type = 'click'), b AS (SELECT * FROM s WHERE event_type = 'view')
    SELECT round((a.m - b.m) / sqrt(a.v / a.n + b.v / b.n), 6) AS t_statistic,
      round(pow(a.v / a.n + b.v / b.n, 2) / (pow(a.v / a.n, 2) / (a.n - 1) + pow(b.v / b.n, 2) / (b.n - 1)), 3) AS freedom FROM a, b
    """,
)
def stream_ab_test(t: Tables) -> DataFrame:
    stats = runner.run_update(jobs.label_statistics(events(t), "event_type", "value"), ["event_type"], "labels")
    out = jobs.welch(stats, "event_type", "click", "view")
    return out.select(F.round("t_statistic", 6).alias("t_statistic"), F.round("freedom", 3).alias("freedom"))


@query(
    "stream_filter_count",
    """
    SELECT 'the' AS token, ((SELECT count(*) FROM documents WHERE contains(text, 'the'))
      + (SELECT count(*) FROM conversations WHERE contains(text, 'the')))::BIGINT AS lines
    """,
)
def stream_filter_count(t: Tables) -> DataFrame:
    inputs = [runner.stream_files(t.spark, t.path(n)) for n in ("documents", "conversations")]
    return runner.run_update(jobs.matching_lines(inputs, "text", "the"), ["token"], "grep")


@query("late_data", "SELECT event_id, event_type FROM events")
def late_data(t: Tables) -> DataFrame:
    """Events sent twice within the delay are kept once."""
    twice = events(t, "1 hour").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = twice.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "event_type")
    return t.spark.read.parquet(runner.run_append(once, "late"))
