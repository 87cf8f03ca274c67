"""Document fingerprints (SimHash), in DataFrame functions only.

The terms of a text are its pairs of neighbouring words (a lone word counts as
a pair with nothing).  A term weighs as much as it occurs: each occurrence
adds its weight to the bits its 64-bit hash sets and takes it from the others.
Bits with a positive sum are set in the fingerprint; a text without words has
fingerprint 0.

The votes are added up four bits at a time: a 64-bit sum holds four counters
of 16 bits, so 16 sums do for 64 bits.  Terms are counted in parts of 2,048
positions of one row, which keeps every counter below its width, then parts are
added, however many rows repeat a key.

``near`` finds all fingerprints within a Hamming radius.  Cut into blocks, two
fingerprints that differ in ``radius`` bits agree in all but ``radius`` of the
blocks; there is one table per choice of the agreeing blocks, keyed by them.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_of

BITS, LANES, WIDTH, PART = 64, 16, 16, 2048
_LANE_MASK = 0x0001_0001_0001_0001
_NO_ID = -(2**63)


def terms(text: Column) -> Column:
    """Hashes of the neighbouring word pairs of a text, one per occurrence."""
    none = F.expr("CAST(array() AS array<bigint>)")

    def pairs(w: Column) -> Column:
        many = F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.xxhash64(a, b))
        return F.when(F.size(w) == 0, none).when(F.size(w) == 1, F.array(F.xxhash64(F.element_at(w, 1), F.lit("")))).otherwise(many)

    return let(words_of(text), pairs)


def _votes(hashed: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprint (bigint) per key from rows of ``keys`` and the array ``hashes``."""
    # The number of the row keeps apart those that repeat a key: a counter never sees more than PART positions of one.
    rows = hashed.withColumn("__row", F.monotonically_increasing_id()).select(*keys, "__row", F.posexplode_outer("hashes").alias("__at", "__h"))
    part = rows.groupBy(*keys, "__row", F.floor(F.col("__at") / PART).alias("__part")).agg(
        F.count("__h").alias("__n"),
        *[F.sum(F.shiftrightunsigned("__h", k).bitwiseAND(F.lit(_LANE_MASK))).alias(f"__s{k}") for k in range(LANES)],
    )
    ones = lambda bit: F.shiftrightunsigned(f"__s{bit % LANES}", WIDTH * (bit // LANES)).bitwiseAND(F.lit(0xFFFF))
    # A key may have any number of rows, so the second level has a sum for every bit.
    whole = part.groupBy(*keys).agg(F.sum("__n").alias("__n"), *[F.sum(ones(b)).alias(f"__t{b}") for b in range(BITS)])
    fingerprint = F.lit(0).cast("long")
    for bit in range(BITS):
        fingerprint = fingerprint.bitwiseOR(F.when(2 * F.col(f"__t{bit}") > F.col("__n"), F.lit(1 << bit if bit < 63 else _NO_ID).cast("long")).otherwise(F.lit(0).cast("long")))
    return whole.select(*keys, fingerprint.alias("fingerprint"))


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One fingerprint (bigint) per distinct ``keys``; null texts count as empty.

    Rows that repeat a key and its text do not change its fingerprint.
    """
    return _votes(docs.select(*keys, terms(F.col(text)).alias("hashes")), keys)


def hexed(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _tables(radius: int, spare: int) -> list[int]:
    """Bit masks of the permuted tables: all choices of ``spare`` agreeing blocks."""
    blocks = radius + spare
    cut = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(cut[i], cut[i + 1])) for i in range(blocks)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(masks[i] for i in chosen)) for chosen in combinations(range(blocks), spare)]


def near(queries: DataFrame, everything: DataFrame, radius: int = 3, spare: int = 2) -> DataFrame:
    """All pairs (``query``, ``found``) of fingerprints at most ``radius`` bits apart, each once.

    Both inputs have a bigint column ``fingerprint``; duplicates and nulls are
    taken out first.  ``spare`` is the number of blocks that must agree: more
    blocks make longer keys (fewer chance candidates) and more tables.
    """
    masks = _tables(radius, spare)

    def keyed(df: DataFrame, name: str) -> DataFrame:
        distinct = df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
        keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col(name).bitwiseAND(F.lit(m)).alias("block")) for t, m in enumerate(masks)])
        return distinct.select(name, F.explode(keys).alias("__key")).select(name, "__key.t", "__key.block")

    pairs = keyed(queries, "query").join(keyed(everything, "found"), ["t", "block"])
    differ = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(masks)])
    return pairs.where((F.bit_count(differ) <= radius) & (first == F.col("t"))).select("query", "found")


def with_next(docs: DataFrame, id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """``doc_id``, ``text``, ``digest`` and the ``next_id``, ``next_text``, ``next_digest`` of the next row by descending id.

    After the last comes the first.  Rows of one id go by the digest of their
    text; null ids come last; null texts count as empty.

    Ids are cut at quantiles into buckets and each bucket is ordered by itself.
    The quantiles are ids that exist, so rows that close a bucket are known and
    go along to the following bucket as well, where they only lend their text.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(_NO_ID)).alias("__id"),
        F.col(id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("digest", F.md5("text"))
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(_NO_ID)).cast("double").alias("__v"))
    cuts = order.agg(
        F.percentile_approx("__v", [i / n for i in range(1, n)] or [0.5], 8 * n).alias("cuts"), F.max("__v").alias("top")
    ).first()
    ends = sorted({*(cuts["cuts"] or []), cuts["top"]}) if cuts["top"] is not None else [0.0]
    place, all_ends = F.col("__id").cast("double"), F.array(*[F.lit(float(x)) for x in ends])
    bucket = F.size(F.filter(all_ends, lambda e: e < place))
    own = rows.withColumn("__bucket", bucket)
    goes = F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("lent")))
    lent = F.struct(((F.col("__bucket") + 1) % len(ends)).alias("b"), F.lit(True).alias("lent"))
    dealt = own.withColumn("__to", F.explode(F.when(F.get(all_ends, F.col("__bucket")) == place, F.concat(goes, F.array(lent))).otherwise(goes)))
    # Lent rows stand before all others of their bucket.
    by = "PARTITION BY __to.b ORDER BY __to.lent DESC, __id, digest"
    near_by = dealt.select("*", *[F.expr(f"lag({c}) OVER ({by})").alias(f"next_{c}") for c in ("__id", "text", "digest")])
    return near_by.where(~F.col("__to.lent")).select("__id", "doc_id", "text", "digest", F.col("next___id").alias("next_id"), "next_text", "next_digest")
