"""Secret scans, in DataFrame functions only.

Patterns find the known kinds.  Beside them a window slides over every
candidate string and keeps the Shannon entropy of its characters: one count
goes up, one goes down, and only their two terms of the sum change.  A string
is taken as a secret when the entropy of some window reaches the level of the
string's character class, unless the allow-list knows it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# Fixed by the contract: the base kinds, in their order.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
# The same matches, but runs too short to count are never taken up.
_ACCESS = r"AKIA[A-Z0-9]{12,}"
_HEX = r"[0-9a-f]{32,}"
_LEAST_VALUE = 8

#: Characters of a window; shorter strings, of ``LEAST`` characters and more, are one window.
WINDOW, LEAST = 20, 16


@dataclass(frozen=True)
class CharClass:
    """Strings that match ``pattern`` whole; the entropy of a window of 20 must reach ``bits``.

    A shorter window has fewer different characters at best, so its level is
    lower in proportion to the logarithm of its length.
    """

    name: str
    pattern: str
    bits: float


# The first class that fits a string counts.  Twenty characters drawn at random have about 3.0 bits
# from 10 digits, 3.4 from 16, 3.8 from 26 letters, 4.0 from 52 or 62; words of as many letters 3.2 to 3.6.
CLASSES = (
    CharClass("digits", r"[0-9]+", 2.8),
    CharClass("hex", r"(?=.*[0-9])[0-9a-f]+|(?=.*[0-9])[0-9A-F]+", 3.2),
    CharClass("one case", r"[a-z]+|[A-Z]+", 3.75),
    CharClass("both cases", r"[A-Za-z]+", 3.85),
    CharClass("mixed", r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_=-]+", 3.7),
    CharClass("signs", r"[A-Za-z+/_=-]+", 4.0),
)
# Strings that look random and are not secrets: UUIDs, dates, place holders, counted and joined plain words.
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[0-9]{4}[-/_]?[0-9]{2}[-/_]?[0-9]{2}([0-9]{4,6}|[^0-9].*)?",
    r"(?i).*(example|sample|placeholder|dummy|redacted|xxxx|abcdef|123456789).*",
    r"[A-Za-z]+([/_=-][A-Za-z]+)*[/_=-]?[0-9]{1,4}",
    r"[/_=+-]*([A-Z]?[a-z]{2,}|[A-Z]{2,})([/_=+-]+([A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]{1,4}))+[/_=+-]*",
    r"[A-Z]?[a-z]{2,}([A-Z][a-z]{2,})+",
)
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: What lies between separators is looked at by itself where the whole is no secret.
PART = rf"[A-Za-z0-9+]{{{LEAST},}}"
#: Different characters that a string of letters alone must have to reach its level.
_LETTERS = 13

_SPAN = "array<struct<start:int,kind:int,stop:int>>"
_KEPT = "array<struct<start:int,kind:int,stop:int,match:string>>"
KINDS = ("assign", "access", "hex", "entropy")


def spans_of(text: Column, pattern: str, kind: int, good=None, keep: bool = False) -> Column:
    """Leftmost non-overlapping matches as (start, kind, stop) in code points; with ``keep`` also ``match``, their text.

    The text between the matches comes from ``split`` with the same pattern,
    so each match starts where the lengths before it end.
    """

    none = F.expr(f"CAST(array() AS {_KEPT if keep else _SPAN})")

    def place(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

        def step(a: Column, x: Column) -> Column:
            begin = a["at"] + F.length(x["gap"])
            end = begin + F.length(x["match"])
            more = [x["match"].alias("match")] if keep else []
            span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("stop"), *more))
            taken = F.concat(a["spans"], span) if good is None else F.when(good(x["match"]), F.concat(a["spans"], span)).otherwise(a["spans"])
            return F.struct(end.alias("at"), taken.alias("spans"))

        pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
        return F.aggregate(pairs, start, step, lambda a: a["spans"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, none).otherwise(place(m)))


def window_entropy(string: Column, most: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits) of any ``most`` characters in a row; a shorter string is one window.

    ``sum(c * log2 c)`` over the counts of the window is kept as it slides;
    the entropy is ``log2(width) - sum / width``.
    """
    term = lambda c: F.when(c <= 1, F.lit(0.0)).otherwise(c * F.log2(c.cast("double")))

    def slide(chars: Column, width: Column) -> Column:
        codes = F.array_distinct(chars)

        def run(code: Column) -> Column:
            place = F.transform(chars, lambda c: F.array_position(code, c).cast("int"))
            zero = F.transform(code, lambda c: F.lit(0))
            start = F.struct(zero.alias("n"), F.lit(0.0).alias("sum"), F.lit(1e9).alias("least"), F.lit(0).alias("i"))

            def step(a: Column, p: Column, all_places: Column) -> Column:
                gone = F.when(a["i"] >= width, F.get(all_places, a["i"] - width)).otherwise(F.lit(0))
                up, down = F.element_at(a["n"], p), F.when(gone > 0, F.element_at(a["n"], F.greatest(gone, F.lit(1))))
                moved = gone != p
                total = F.when(
                    moved,
                    a["sum"] + term(up + 1) - term(up) + F.when(gone > 0, term(down - 1) - term(down)).otherwise(0.0),
                ).otherwise(a["sum"])
                counts = F.when(
                    moved,
                    F.transform(a["n"], lambda c, k: c + F.when(k + 1 == p, 1).otherwise(0) - F.when(k + 1 == gone, 1).otherwise(0)),
                ).otherwise(a["n"])
                least = F.when(a["i"] >= width - 1, F.least(a["least"], total)).otherwise(a["least"])
                return F.struct(counts.alias("n"), total.alias("sum"), least.alias("least"), (a["i"] + 1).alias("i"))

            return let(place, lambda ps: F.aggregate(ps, start, lambda a, p: step(a, p, ps), lambda a: a["least"]))

        return let(codes, run)

    def of(width: Column) -> Column:
        least = let(F.split(string, ""), lambda chars: slide(chars, width))
        return F.log2(width.cast("double")) - least / width

    return let(F.least(F.length(string), F.lit(most)), of)


def looks_secret(string: Column) -> Column:
    """Whether a string is long enough, is not on the allow-list and is random enough for its class."""
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | string.rlike(f"^(?:{pattern})$")
    level = F.lit(None).cast("double")
    for c in reversed(CLASSES):
        level = F.when(string.rlike(f"^(?:{c.pattern})$"), F.lit(c.bits)).otherwise(level)
    scaled = level * F.log2(F.least(F.length(string), F.lit(WINDOW)).cast("double")) / F.log2(F.lit(float(WINDOW)))
    # The cheap tests come first; no window slides where its characters are too few to reach the level.
    different = F.log2(F.size(F.array_distinct(F.split(string, ""))).cast("double"))
    tested = let(scaled, lambda bits: F.when(different < bits, F.lit(False)).otherwise(window_entropy(string) >= bits - 1e-9))
    return F.when((F.length(string) < LEAST) | allowed, F.lit(False)).otherwise(F.coalesce(tested, F.lit(False)))


def _perhaps(string: Column) -> Column:
    """Whether a candidate needs a closer look: most are long words."""
    return string.rlike("[0-9+/_=-]") | (F.size(F.array_distinct(F.split(string, ""))) >= _LETTERS)


def _span(start: Column, stop: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(3).alias("kind"), stop.alias("stop"))


def _secrets_in(string: Column, start: Column) -> Column:
    """The span of a string that begins at ``start``, if it is a secret; else of its parts that are."""
    parts = F.transform(spans_of(string, PART, 3, looks_secret), lambda x: _span(start + x["start"], start + x["stop"]))
    inside = F.when(string.rlike("[/_=-]"), parts).otherwise(F.expr(f"CAST(array() AS {_SPAN})"))
    return F.when(looks_secret(string), F.array(_span(start, start + F.length(string)))).otherwise(inside)


def _uncovered(text: Column, span: Column, base: Column) -> Column:
    """Secrets in a candidate, or in its stretches beside the base spans that cut it."""
    cuts = F.filter(base, lambda x: (x["start"] < span["stop"]) & (span["start"] < x["stop"]))

    def step(a: Column, x: Column) -> Column:
        spans = F.when(x["start"] > a["at"], F.concat(a["spans"], F.array(_span(a["at"], x["start"])))).otherwise(a["spans"])
        return F.struct(F.greatest(a["at"], x["stop"]).alias("at"), spans.alias("spans"))

    def beside(cut: Column) -> Column:
        start = F.struct(span["start"].alias("at"), F.expr(f"CAST(array() AS {_SPAN})").alias("spans"))
        left = F.aggregate(cut, start, step, lambda a: F.when(a["at"] < span["stop"], F.concat(a["spans"], F.array(_span(a["at"], span["stop"])))).otherwise(a["spans"]))
        long = F.filter(left, lambda x: x["stop"] - x["start"] >= LEAST)
        return F.flatten(F.transform(long, lambda x: let(F.substring(text, x["start"] + 1, x["stop"] - x["start"]), lambda piece: _secrets_in(piece, x["start"]))))

    return let(cuts, lambda cut: F.when(F.size(cut) == 0, _secrets_in(span["match"], span["start"])).otherwise(beside(cut)))


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Spans of each document: ``base`` by pattern, ``added`` by entropy, sorted by start and kind.

    Null texts count as empty and have no spans.  An added span never overlaps
    a base span; of a candidate that does, the stretches beside are looked at.
    Where a candidate is no secret as a whole, its parts between ``/``, ``_``,
    ``=`` and ``-`` are judged by themselves, by the allow-list too.  Repeated
    rows give repeated results; only ``id`` and ``text`` are read, so other columns may have any name.  With ``carry`` the whole row
    comes along as the struct ``row``.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    body = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"), *row)
    more = ["row"] if carry else []
    long_value = lambda m: F.length(F.regexp_extract(m, PATTERNS["assign"], 2)) >= _LEAST_VALUE
    t = F.col("__text")
    base = F.concat(
        spans_of(t, PATTERNS["assign"], 0, long_value),
        spans_of(t, _ACCESS, 1),
        spans_of(t, _HEX, 2),
    )
    found = body.select("doc_id", *more, "__text", F.array_sort(base).alias("base"), spans_of(t, CANDIDATE, 3, _perhaps, keep=True).alias("__more"))
    free = let(F.col("base"), lambda b: F.flatten(F.transform("__more", lambda m: _uncovered(t, m, b))))
    none = F.expr(f"CAST(array() AS {_SPAN})")
    out = found.select("doc_id", *more, "base", F.when(F.size("__more") == 0, none).otherwise(free).alias("added"))
    return out.select("*", F.array_sort(F.concat("base", "added")).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch covered by spans replaced by ``mark``."""

    def merge(a: Column, s: Column) -> Column:
        inside = s["start"] < a["at"]
        piece = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        return F.struct(
            F.when(inside, a["out"]).otherwise(F.concat(a["out"], piece, F.lit(mark))).alias("out"),
            F.greatest(a["at"], s["stop"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    whole = F.aggregate(spans, start, merge, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)
