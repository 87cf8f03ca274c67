"""Many rows with one key and text."""

from __future__ import annotations

import brute
from pyspark.sql import functions as F

from marlstone.llm import fingerprints as fp


def test_repeated_rows_do_not_change_a_fingerprint(spark):
    text = " ".join(f"w{k % 97}x{k}" for k in range(2100))
    other = "a b c d e f g"
    docs = spark.range(1000).select(F.lit(None).cast("bigint").alias("doc_id"), F.when(F.col("id") == 3, other).otherwise(text).alias("text")).withColumn("digest", F.md5("text"))
    got = {r["digest"]: r["fingerprint"] for r in fp.fingerprints(docs, ["doc_id", "digest"]).collect()}
    assert sorted(got.values()) == sorted(w - (w >> 63 << 64) for w in map(brute.fingerprint, (text, other)))
