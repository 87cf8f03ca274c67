"""How many planted random strings are found by class, and how many words are taken for one."""

from __future__ import annotations

import random
import string

import duckdb
import pytest

from marlstone.llm import secrets

LOWER, BOTH, DIGITS = string.ascii_lowercase, string.ascii_letters, string.digits
CASES = {
    "20 digits": (DIGITS, 20, 0.85),
    "32 digits and lower letters": (LOWER + DIGITS, 32, 0.95),
    "18 of all": (BOTH + DIGITS, 18, 0.9),
    "32 of all": (BOTH + DIGITS, 32, 0.98),
    "40 letters of both cases": (BOTH, 40, 0.95),
    "32 letters of both cases": (BOTH, 32, 0.9),
    "40 lower letters": (LOWER, 40, 0.8),
    "40 of base64": (BOTH + DIGITS + "+/", 40, 0.95),
}


@pytest.mark.parametrize("name", list(CASES))
@pytest.mark.parametrize("frame", ["the {} end", "/srv/sample/{} x", "load /data/2024-01-02/{}"])
def test_planted_strings_are_found(spark, name, frame):
    letters, size, least = CASES[name]
    rng = random.Random(size)
    planted = ["".join(rng.choices(letters, k=size)) for _ in range(120)]
    docs = spark.createDataFrame([(i, frame.format(p)) for i, p in enumerate(planted)], "doc_id bigint, text string")
    covered = 0
    for r in secrets.find(docs).collect():
        text = frame.format(planted[r["doc_id"]])
        begin = text.index(planted[r["doc_id"]])
        covered += sum(min(s["stop"], begin + size) - max(s["start"], begin) for s in r["spans"] if s["stop"] > begin) >= 0.8 * size
    # A slash inside a string may be a separator of the path it stands in.
    assert covered >= (least - 0.35 if "base64" in name and "/" in frame else least) * len(planted)


PLAIN = """Donaudampfschifffahrtsgesellschaftskapitaen uncharacteristically internationalization counterrevolutionaries
https://www.example.org/articles/2021/05/17/how-to-grow-tomatoes-in-winter /usr/share/doc/python3-numpy/html getElementsByClassName
2024-01-02 20240102030405 20240102 123e4567-e89b-12d3-a456-426614174000 THE-QUICK-BROWN-FOX ------------------------------ ======================
some_snake_case_identifier_name AVeryLongCamelCaseClassNameFactoryBean version-2-of-the-report 1000000000000000000000 aaaaaaaaaaaaaaaaaaaaaaaaaaaaa"""


def test_plain_strings_are_left_alone(spark):
    docs = spark.createDataFrame(list(enumerate(PLAIN.split())), "doc_id bigint, text string")
    assert [PLAIN.split()[r["doc_id"]] for r in secrets.find(docs).collect() if r["spans"]] == []


def test_false_alarms_in_documents(spark):
    """What entropy adds in the documents is hardly ever made of their words."""
    folder = "/root/testdata/sf0.01"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall())
    words = sum(len(t.split()) for t in texts.values() if t)
    added = [texts[r["doc_id"]][s["start"] : s["stop"]] for r in secrets.find(spark.read.parquet(f"{folder}/documents.parquet")).collect() for s in r["added"]]
    plain = [a for a in added if a.isalpha() and (a.islower() or a[1:].islower())]
    assert len(plain) * 100_000 < words, plain[:20]
