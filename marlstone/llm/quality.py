"""Quality rules as weak supervision, in DataFrame functions only.

Every rule looks at one figure of a document and votes good (1), bad (-1) or
abstains (0).  Documents with the same votes are counted together, so the
expectation-maximisation that follows works on at most 3^rules vote patterns,
whatever the number of documents.  It estimates the share of good documents
and how often each rule votes right and wrong on either class; the posterior
probability of "good" under these replaces the usual demand that every rule
must pass.  A good vote that most bad documents get as well so weighs little.

A vote can only speak for its own side, which keeps the two classes from
changing names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, keep_on_disk, let, words_of

ROUNDS = 20
#: Start of the fit: share of good documents, and by vote its probability on a good and on a bad document.
GOOD = 0.8
START = {1: (0.9, 0.6), 0: (0.08, 0.1), -1: (0.02, 0.3)}
#: Documents that the start is worth.
WEIGHT = 10.0


@dataclass(frozen=True)
class Rule:
    """``good`` and ``bad`` are SQL conditions over the figures of ``figures``."""

    name: str
    good: str
    bad: str

    def vote(self) -> Column:
        return F.expr(f"CASE WHEN {self.bad} THEN -1 WHEN {self.good} THEN 1 ELSE 0 END")


# Short texts repeat by chance, so repeats only count against longer ones.
# Integer comparisons only, so every engine votes alike.
RULES = (
    Rule("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    Rule("repeats", "100 * n_repeat_words <= 20 * n_words", "n_words >= 50 AND 100 * n_repeat_words > 40 * n_words"),
    Rule("echoes", "20 * n_echoes <= n_words", "10 * n_echoes > n_words + 10"),
    Rule("lines", "10 * n_dup_lines <= n_lines", "n_words >= 50 AND 10 * n_dup_lines > 4 * n_lines"),
    Rule("word_length", "word_chars >= 3 * n_words AND word_chars <= 9 * n_words", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule("capitals", "5 * n_capitals <= word_chars", "2 * n_capitals > word_chars"),
    Rule("marks", "20 * n_mark_runs <= n_words", "5 * n_mark_runs > n_words"),
    Rule("sentences", "n_stops >= 1 AND n_words <= 60 * n_stops", "n_words > 200 * n_stops"),
)


def repeated_words(words: Column) -> Column:
    """How many words lie in a three-word window that occurs more than once.

    Window hashes are sorted with their places; neighbours with the same hash
    are repeats.  Over the sorted places of repeated windows each one covers
    three words less what the one before has covered.
    """

    def count(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)),
        )
        return let(windows, covered)

    def covered(hashes: Column) -> Column:
        # Most texts repeat nothing, which a hash set tells at once.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), spread)
        )

    def spread(ordered: Column) -> Column:
        size = F.size(ordered)
        same = lambda i, j: F.get(ordered, i)["h"] == F.get(ordered, j)["h"]
        repeated = F.filter(ordered, lambda x, i: ((i > 0) & same(i, i - 1)) | ((i < size - 1) & same(i, i + 1)))
        places = F.array_sort(F.transform(repeated, lambda x: x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"]).cast("long")).alias("n")),
            lambda a: a["n"],
        )

    return let(words, lambda w: F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(count(w)))


def _left(text: Column, pattern: str) -> Column:
    """Number of characters that stay when ``pattern`` is taken out."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def figures(docs: DataFrame, id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """The counts that the rules look at, one row per document.

    Null and empty texts have zero everywhere.  Repeated rows give repeated
    results; only ``id`` and ``text`` of the input are read, so other columns
    may have any name.  With ``carry`` the whole row comes along as the struct
    ``row``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    split = docs.select(F.col(id).alias("doc_id"), body.alias("__text"), words_of(F.col(text)).alias("__words"), *row)
    lines = F.filter(F.split(F.col("__text"), "\n"), lambda x: x.rlike(WORD))
    both = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("distinct")))
    found = lambda pattern: _left(F.regexp_replace("__text", pattern, "\u0001"), "[^\u0001]+")
    out = split.select(
        "doc_id",
        F.size("__words").cast("long").alias("n_words"),
        F.aggregate("__words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        _left(F.col("__text"), r"[^#*$%&|<>]+").alias("n_symbols"),
        both.alias("__lines"),
        repeated_words(F.col("__words")).alias("n_repeat_words"),
        let(F.col("__words"), lambda w: F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1))))).cast("long").alias("n_echoes"),
        _left(F.col("__text"), r"[^A-ZÀ-ÖØ-Þ]+").alias("n_capitals"),
        # Runs of marks, and bars that stand alone; then words that end with a stop.
        found(rf"[!#*$%&|<>?]{{2,}}|(?<!{WORD})\|(?!{WORD})").alias("n_mark_runs"),
        found(rf"[.!?;:](?!{WORD})").alias("n_stops"),
        *(["row"] if carry else []),
    )
    return out.select("*", F.col("__lines.n").alias("n_lines"), (F.col("__lines.n") - F.col("__lines.distinct")).alias("n_dup_lines")).drop("__lines")


def vote(counted: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    return counted.select("*", *[r.vote().alias(f"vote_{r.name}") for r in rules])


def fit(votes: DataFrame, rules: Sequence[Rule] = RULES, rounds: int = ROUNDS) -> dict[str, object]:
    """Share of good documents and how each rule votes on either class, by expectation-maximisation.

    The pattern counts (at most 3^rules rows, by construction) are what comes
    to the driver; the steps over them are plain arithmetic.  Every count is
    smoothed by the starting odds, worth ``WEIGHT`` documents, so without
    documents the starting values stay.
    """
    names = [f"vote_{r.name}" for r in rules]
    patterns = sorted((tuple(row[n] for n in names), row["n"]) for row in votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect())
    model = {"good": GOOD, **{n: START for n in names}}
    for _ in range(rounds):
        share = [(p, n, posterior(model, dict(zip(names, p, strict=True)))) for p, n in patterns]
        goods, bads = sum(n * q for _, n, q in share), sum(n * (1 - q) for _, n, q in share)
        fitted = {"good": (goods + WEIGHT * GOOD) / (goods + bads + WEIGHT)}
        for k, name in enumerate(names):
            fitted[name] = {}
            for vote, (if_good, if_bad) in START.items():
                seen_good = sum(n * q for p, n, q in share if p[k] == vote)
                seen_bad = sum(n * (1 - q) for p, n, q in share if p[k] == vote)
                fitted[name][vote] = ((seen_good + WEIGHT * if_good) / (goods + WEIGHT), (seen_bad + WEIGHT * if_bad) / (bads + WEIGHT))
        model = fitted
    return model


def evidence(model: dict[str, object], name: str, vote: int) -> float:
    """Log odds that a vote adds; a bad vote never speaks for good, nor a good one for bad."""
    if_good, if_bad = model[name][vote]
    weight = math.log(if_good / if_bad)
    return 0.0 if vote == 0 else min(weight, 0.0) if vote < 0 else max(weight, 0.0)


def posterior(model: dict[str, object], votes: dict[str, int]) -> float:
    """Probability of good; abstaining says nothing."""
    odds = math.log(model["good"] / (1 - model["good"])) + sum(evidence(model, n, v) for n, v in votes.items())
    return 1 / (1 + math.exp(-odds))


def accuracies(model: dict[str, object]) -> dict[str, float]:
    """Share of a rule's votes that are right, given the fitted shares of both classes."""
    out, good = {}, model["good"]
    for name, table in model.items():
        if name != "good":
            right = good * table[1][0] + (1 - good) * table[-1][1]
            out[name] = right / (right + good * table[-1][0] + (1 - good) * table[1][1])
    return out


def probability(model: dict[str, object]) -> Column:
    """Posterior probability that a document is good, from its votes."""
    odds = F.lit(math.log(model["good"] / (1 - model["good"])))
    for name in model:
        if name != "good":
            weight = F.when(F.col(name) > 0, evidence(model, name, 1)).when(F.col(name) < 0, evidence(model, name, -1)).otherwise(0.0)
            odds = odds + weight
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES, least: float = 0.5, rounds: int = ROUNDS, carry: bool = False) -> DataFrame:
    """Figures, votes, ``quality`` (posterior) and ``good`` (``quality >= least``) of each document."""
    voted = keep_on_disk(vote(figures(docs, id, text, carry), rules), "quality-votes")
    model = fit(voted, rules, rounds)
    return voted.select("*", probability(model).alias("quality")).select("*", (F.col("quality") >= least).alias("good"))


def fit_sql(patterns: str, rules: Sequence[Rule] = RULES, rounds: int = ROUNDS) -> str:
    """The same fit as a chain of SQL steps over the table ``patterns`` (votes and ``n``); ends with the one-row table ``model``."""
    steps, names = [], [r.name for r in rules]
    start = ", ".join(f"{START[v][c]} AS {k}_{n}" for n in names for v, c, k in _PARTS)
    steps.append(f"model0 AS MATERIALIZED (SELECT {GOOD} AS good, {start})")
    for i in range(rounds):
        last = "model" if i + 1 == rounds else f"model{i + 1}"
        steps.append(f"share{i} AS MATERIALIZED (SELECT p.*, {posterior_sql(rules)} AS q FROM {patterns} p, model{i})")
        fitted = ", ".join(
            f"(coalesce(sum(n * {q}) FILTER (vote_{n} = {v}), 0) + {WEIGHT * START[v][c]}) / (sum(n * {q}) + {WEIGHT}) AS {k}_{n}"
            for n in names
            for v, c, k in _PARTS
            for q in ["q" if c == 0 else "(1 - q)"]
        )
        steps.append(f"{last} AS MATERIALIZED (SELECT (sum(n * q) + {WEIGHT * GOOD}) / (sum(n) + {WEIGHT}) AS good, {fitted} FROM share{i})")
    return ",\n".join(steps)


#: Vote, class and column prefix of the fitted shares that the posterior needs.
_PARTS = ((1, 0, "good_if_good"), (1, 1, "good_if_bad"), (-1, 0, "bad_if_good"), (-1, 1, "bad_if_bad"))


def posterior_sql(rules: Sequence[Rule] = RULES) -> str:
    """Posterior of a row with votes, beside the columns of a model."""
    terms = [
        f"CASE vote_{r.name} WHEN 1 THEN greatest(ln(good_if_good_{r.name} / good_if_bad_{r.name}), 0) WHEN -1 THEN least(ln(bad_if_good_{r.name} / bad_if_bad_{r.name}), 0) ELSE 0 END"
        for r in rules
    ]
    return f"1 / (1 + exp(-(ln(good / (1 - good)) + {' + '.join(terms)})))"
