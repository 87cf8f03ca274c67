"""Named queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, language, line_dedup, near_dedup, packing, periodic, quality, secrets, simhash_dedup, token_counts, url_filter
from . import conversation_trie as ct
from . import fingerprints as fp
from .common import documents, keep_on_disk, words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that repeat an earlier line, nearly or exactly."""
    docs = documents(spark, folder)
    n_lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines")
    return line_dedup.clean(docs.select("doc_id", "text", n_lines), count="n_removed")


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of each text by the multilingual ranks, and the bytes that they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(documents(spark, folder), path, offsets=False)
    facts = encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids"
    )
    decoded = bpe.decode(facts, path, text=False)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash of each text, of its edited text and of the next document.

    ``near_docs`` counts, for documents whose id is divisible by 100, the other
    documents within three bits; it is null for the rest.
    """
    linked = fp.with_next(documents(spark, folder))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    # One copy of the text in, both versions out: the terms of each, told apart by ``__edited``.
    # ``doc_id`` is only named so that this branch and ``facts`` share one shuffle of the texts.
    versions = linked.select("__id", "doc_id", "digest", F.col("text").alias("t0"), edited.alias("t1"))
    stacked = versions.select("__id", "doc_id", "digest", F.expr("stack(2, false, t0, true, t1) AS (__edited, body)"))
    prints = fp.fingerprints(stacked, ["__id", "doc_id", "digest", "__edited"], "body").groupBy("__id", "digest").agg(
        F.max(F.when(~F.col("__edited"), F.col("fingerprint"))).alias("own"),
        F.max(F.when(F.col("__edited"), F.col("fingerprint"))).alias("edited"),
    )
    facts = linked.select("__id", "doc_id", "digest", "next_id", "next_digest", F.length("text").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"))
    following = prints.select(F.col("__id").alias("next_id"), F.col("digest").alias("next_digest"), F.col("own").alias("following"))
    whole = keep_on_disk(facts.join(prints, ["__id", "digest"]).join(following, ["next_id", "next_digest"]), "fingerprints")
    copies = whole.groupBy(F.col("own").alias("found")).agg(F.count(F.lit(1)).alias("n"))
    asked = whole.where(F.col("doc_id") % 100 == 0).select(F.col("own").alias("fingerprint"))
    counted = fp.near(asked, whole.select(F.col("own").alias("fingerprint"))).join(copies, "found").groupBy(F.col("query").alias("own")).agg((F.sum("n") - 1).alias("near_docs"))
    return whole.join(counted, "own", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fp.hexed(F.col("own")).alias("fingerprint"),
        fp.hexed(F.col("edited")).alias("edited_fingerprint"),
        fp.likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        fp.likeness(F.col("own"), F.col("following")).alias("near_next"),
        F.when(F.col("doc_id") % 100 == 0, F.col("near_docs")).alias("near_docs"),
    )


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of each text as the library counts them."""
    counted = token_counts.count(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, the fixed base rule and the verdict of the weighted rules."""
    judged = quality.judge(documents(spark, folder))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    votes = [F.col(f"vote_{r.name}") for r in quality.RULES]
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), *votes,
    )


@query
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in bins of 2,048 words, no bin with two of a source or two copies of a text."""
    docs = documents(spark, folder)
    return packing.pack(docs.select("doc_id", F.size(words_of(F.col("text"))).alias("length"), "source", F.xxhash64("text").alias("cluster")))


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of each text, by a network that has not seen the held-out quarter."""
    docs = documents(spark, folder)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    net = language.fit(docs.where(~held_out).select("text", "lang"))
    return language.predict(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: Fixed by the contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The longest rule that fits each page's address, and its verdict."""
    return url_filter.judge(spark.read.parquet(f"{folder.rstrip('/')}/pages.parquet"), url_filter.publish(spark, URL_RULES))


@query
def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of word pairs are at least 80 % alike."""
    return near_dedup.groups(documents(spark, folder), width=2)


@query
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and digest, and all spans with those found by entropy."""
    found = secrets.find(documents(spark, folder))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def _repeating(docs: DataFrame) -> DataFrame:
    """The documents of which every tenth, by its hash, repeats its end from some word on.

    Documents without an id or without words stay as they are.
    """
    words = words_of(F.col("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size("w").cast("long"), F.floor(h / 10)
    from_word = F.col("a")
    source = lambda i: F.when(i < from_word, i).otherwise(from_word + (i - from_word) % F.col("p"))
    body = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(F.col("w"), source(i).cast("int"))), " ")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).otherwise(F.array().cast("array<string>")).alias("w"), g.alias("g"))
    placed = chosen.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))))
    return placed.select("doc_id", F.when(n > 0, body).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeated words of each text, every tenth of which is made to repeat, and the texts without them."""
    found = periodic.find(_repeating(documents(spark, folder)))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    facts = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return facts.select(
        "doc_id", "n_runs", F.col("r.s").alias("start"), (-F.col("r.l")).alias("length"), F.col("r.p").alias("period"),
        F.floor(-1000 * F.col("r.l") / F.col("r.p")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query
def op12_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose fingerprints differ in two bits at most."""
    return simhash_dedup.groups(documents(spark, folder)).select("doc_id", fp.hexed(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the trie of conversations that begin with the first turns of the first of their twenty."""
    turns = keep_on_disk(ct.number(spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet")), "trie-numbered")
    own = turns.groupBy("conv_id").agg(F.max("place").alias("own"), F.min("chunk").alias("first_chunk"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    asked = own.select("conv_id", "own", "first_chunk", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    base = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_length"))
    given = F.least("h", F.coalesce("base_length", F.lit(0)))
    planned = asked.join(base, "base", "left").select("conv_id", "first_chunk", "h", "base", given.alias("given"), (given + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    plan = keep_on_disk(planned, "trie-plan")
    shared = turns.where("conv_id % 20 = 0 AND place <= 3").select(F.col("conv_id").alias("base"), "place", "h1", "h2", "words")
    begin = plan.join(shared, "base").where("place <= h").select("conv_id", F.col("first_chunk").alias("chunk"), "place", "h1", "h2", "words", "length")
    rest = turns.join(plan, "conv_id").where("place > h").select("conv_id", "chunk", (F.col("given") + F.col("place") - F.col("h")).alias("place"), "h1", "h2", "words", "length")
    return ct.build(begin.unionByName(rest), plan.select("conv_id", "length"))


_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op5_quality_rules"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, {_WORDS.format(text="text")} AS w FROM documents),
lines AS (SELECT row, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM docs),
windows AS (SELECT row, unnest(range(1, len(w) - 1)) AS i, w FROM docs WHERE len(w) > 2),
repeated AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, w[i], w[i + 1], w[i + 2]) AS n FROM windows) WHERE n > 1),
covered AS (SELECT row, count(DISTINCT i + j) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS j) GROUP BY row),
counted AS (
  SELECT docs.row, doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes, length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]+', '', 'g')) AS n_capitals,
    len(regexp_extract_all(t, '[!#*$%&|<>?]{{2,}}')) + len(list_filter(w, lambda x: x = '|')) AS n_mark_runs,
    len(list_filter(w, lambda x: regexp_matches(x, '[.!?;:]$'))) AS n_stops
  FROM docs JOIN lines USING (row) LEFT JOIN covered USING (row)),
voted AS MATERIALIZED (SELECT *, {", ".join(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS vote_{r.name}" for r in quality.RULES)} FROM counted),
patterns AS MATERIALIZED (SELECT {", ".join(f"vote_{r.name}" for r in quality.RULES)}, count(*) AS n FROM voted GROUP BY ALL),
{quality.fit_sql("patterns")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND q >= 0.5 AS kept, {", ".join(f"vote_{r.name}" for r in quality.RULES)}
FROM (SELECT voted.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {quality.posterior_sql()} AS q FROM voted, model)
"""

ORACLES["op8_url_filter"] = rf"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
parts AS (
  SELECT row_number() OVER () AS row, page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
fits AS (
  SELECT row, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY row)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (row)
"""

ORACLES["op9_minhash"] = rf"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(text=f"translate(text, '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b USING (x) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM words UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""
