from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Every column clashes with a name that some operator uses inside or returns.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fingerprint string, id int, row string, line int, good string, spans string, quality string"


def sentence(rng: random.Random, n: int) -> str:
    syllables = "the and of ti on er re en at ing tion ha ou ble st".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


def sample(seed: int = 1) -> list[tuple]:
    """Documents with nulls, empty and long texts, ties, copies, near copies and secrets."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", "   \n\t ", "One", "one two", "Ünï çødé 日本語 😀 text", "a\n\nb\n", "\n", "x" * 3000]
    texts += [None, "", "One"]
    shared = sentence(rng, 60)
    for k in range(30):
        lines = [sentence(rng, rng.randint(8, 40)) for _ in range(rng.randint(2, 6))]
        if k % 3 == 0:
            lines.insert(1, shared)
        if k % 4 == 0:
            lines.append(shared.upper().replace("THE", "the") + " 2024")
        if k % 5 == 0:
            lines.append(f'token = "{rng.randbytes(20).hex()}" end')
        if k % 7 == 0:
            lines.append("key AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)) + " and blob q8Zr2LmX0vTb7KpW4nYc6HdJ here")
        texts.append("\n".join(lines))
    whole = texts[20]
    texts += [whole, whole, whole.replace("the", "The", 3)]
    words = whole.split(" ")
    for k in range(6):  # near copies with one or two words changed
        other = list(words)
        other[5 + k] = "changed"
        texts.append(" ".join(other))
    texts.append(" ".join(sentence(rng, 50) for _ in range(400)))  # 20,000 words in one line
    texts.append("spam spam spam " * 200)
    texts.append(" | ".join(rng.choices("alpha beta gamma delta".split(), k=120)))
    texts.append(" ".join(x.upper() + "!!" for x in sentence(rng, 120).split()))
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    return [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s1", None]), None if t is None else len(t), "f", 7, "r", 1, "g", "s", "q") for i, t in rows]


@pytest.fixture(scope="session")
def rows():
    return sample()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The sample, its rows spread over a few partitions."""
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def odd(spark, rows):
    """The sample with repeated rows, a repeated id with another text, and rows without an id."""
    more = [rows[20], rows[20], (rows[21][0], "another text with this id. " * 5, *rows[21][2:]), (None, "no id here at all " * 4, *rows[0][2:]), (None, None, *rows[0][2:])]
    return spark.createDataFrame([*rows, *more], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
