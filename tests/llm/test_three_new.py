"""Periodic runs, SimHash groups and the conversation trie against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from marlstone.llm import conversation_trie as ct
from marlstone.llm import periodic, simhash_dedup
from marlstone.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


# --- periodic runs -----------------------------------------------------------


def runs_of(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                found.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng):
    letters = "ab"[: rng.randint(1, 2)] + "cdefg"[: rng.randint(0, 5)]
    n = rng.choice([0, 1, 5, 11, 12, 30, 80, 200])
    words = [rng.choice(letters) for _ in range(n)]
    if n > 3 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // (3 + rng.randrange(8))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_of_random_words(spark):
    rng = random.Random(11)
    texts = [repetitive(rng) for _ in range(400)]
    rows = [(k if k % 9 else None, rng.choice([" ", "\n ", "\t"]).join(w)) for k, w in enumerate(texts)]
    found = periodic.find(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    key = lambda i, n, runs, text: (-1 if i is None else i, n, runs, text)
    got = sorted(key(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found)
    assert got == sorted(key(i, len(w), runs_of(w), collapsed(w, runs_of(w))) for (i, _), w in zip(rows, texts))


@pytest.mark.parametrize("least", [3, 4, 7, 20])
def test_other_least_lengths(least):
    rng = random.Random(least)
    for _ in range(150):
        words = repetitive(rng)
        _, runs, _ = periodic._found(pa.array([" ".join(words), "x y"]), least)
        assert [(r["start"], r["length"], r["period"]) for r in runs[0].as_py()] == runs_of(words, least)


def test_grammar_tells_how_far_places_agree():
    rng = random.Random(2)
    for _ in range(60):
        word = np.array([rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(2, 90))])
        grammar = periodic.Grammar(word)
        pairs = [(i, j) for i in range(len(word)) for j in range(i + 1, len(word))]
        x, y = np.array(pairs).T
        ahead = [next((k for k in range(len(word)) if j + k >= len(word) or word[i + k] != word[j + k]), 0) for i, j in pairs]
        behind = [next((k for k in range(i + 1) if k == i or word[i - 1 - k] != word[j - 1 - k]), 0) for i, j in pairs]
        assert grammar.ahead(x, y).tolist() == ahead
        assert grammar.behind(x, y).tolist() == behind


def test_long_texts_of_few_words():
    one = " ".join(["w"] * 200_000)
    rng = random.Random(1)
    two = [rng.choice("ab") for _ in range(3000)]
    sizes, runs, left = periodic._found(pa.array([one, " ".join(two)]), 12)
    assert sizes.tolist() == [200_000, 3000]
    assert runs[0].as_py() == [{"start": 0, "length": 200_000, "period": 1}] and left[0].as_py() == "w"
    assert [(r["start"], r["length"], r["period"]) for r in runs[1].as_py()] == runs_of(two)


def test_collapse_keeps_other_columns(spark, docs, nothing):
    want = {r["doc_id"]: r for r in docs.collect()}
    for r in periodic.collapse(docs).collect():
        old, w = want[r["doc_id"]], brute.words(want[r["doc_id"]]["text"])
        assert {**r.asDict(), "text": None} == {**old.asDict(), "text": None}
        assert r["text"] == (collapsed(w, runs_of(w)) if runs_of(w) else old["text"])
    assert periodic.find(nothing).count() == 0 == periodic.collapse(nothing).count()


def test_runs_of_odd_rows(odd):
    assert periodic.find(odd).count() == odd.count()


def test_op11(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    some = 0
    for i, text in docs:
        w, h = brute.words(text), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        runs = runs_of(w)
        some += bool(runs)
        r = got[i]
        s, n, q = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), s, n, q, 1000 * n // q if q else None)
        assert r["runs_sha256"] == brute.sha("".join(f"{a},{b},{c}\n" for a, b, c in runs))
        assert r["collapsed_sha256"] == brute.sha(collapsed(w, runs))
    assert some > 10


# --- SimHash groups ----------------------------------------------------------


def shingle_print(text, width=3):
    w = brute.words((text or "").translate(brute.UPPER))
    runs = [" ".join(w)] if 0 < len(w) < width else [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)]
    return brute.simhash([xxhash.xxh64_intdigest(x.encode(), 42) for x in runs])


def print_groups(docs, radius=2):
    """Smallest id by place in ``docs`` (id, text)."""
    prints = [shingle_print(t) for _, t in docs]
    links = [(x, y) for x in range(len(docs)) for y in range(x) if (prints[x] ^ prints[y]).bit_count() <= radius]
    label = brute.components(range(len(docs)), links)
    least = defaultdict(list)
    for x, g in label.items():
        least[g] += [docs[x][0]] if docs[x][0] is not None else []
    return [(docs[x][0], prints[x], min(least[label[x]], default=None)) for x in range(len(docs))]


def check_groups(df, docs):
    key = lambda r: tuple(-1 if v is None else v for v in r)
    got = sorted((key((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"])) for r in simhash_dedup.groups(df).collect()))
    assert got == sorted(map(key, print_groups(docs)))


def test_simhash_groups(docs, odd, nothing):
    check_groups(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])
    check_groups(odd, [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert simhash_dedup.groups(nothing).count() == 0


def near_prints(spark, rng, n, spread):
    """Fingerprints around a few centres, most around one; in all, every link is known."""
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = set()
    while len(prints) < n:
        x = centres[0] if rng.random() < 0.6 else rng.choice([*centres, rng.getrandbits(64)])
        for _ in range(rng.randint(0, spread)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    return sorted(prints)


@pytest.mark.parametrize("radius,spread", [(2, 3), (2, 6), (1, 3), (3, 7), (0, 2)])
def test_no_link_between_fingerprints_is_missed(spark, monkeypatch, radius, spread):
    rng = random.Random(radius * 10 + spread)
    monkeypatch.setattr(simhash_dedup, "BLOCK", 16)
    prints = near_prints(spark, rng, 500, spread)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    label = brute.components(range(len(prints)), [(x, y) for x in range(len(prints)) for y in range(x) if (prints[x] ^ prints[y]).bit_count() <= radius])
    groups = defaultdict(set)
    for x, g in label.items():
        groups[g].add(signed[x])
    got = defaultdict(set)
    for r in simhash_dedup.linked(spark.createDataFrame([(p,) for p in signed], "id bigint"), radius).collect():
        got[r["label"]].add(r["id"])
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_frequent_values_are_passed_by():
    rng = random.Random(5)
    parts = [list(range(0, 21)), list(range(21, 42)), list(range(42, 64))]
    plan = simhash_dedup.Layout(1_000_000, np.full(64, 0.5), parts, [(np.array([0], np.uint64), np.array([300_000])), *[(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2])
    prints = np.array([rng.getrandbits(64) for _ in range(50)], dtype=np.uint64)
    prints[:25] &= ~np.uint64((1 << 21) - 1)
    limits = simhash_dedup.thresholds(prints, plan, 2)
    assert (limits.sum(axis=1) + 3 == 3).all()
    assert (limits[:25, 0] == -1).all() and (limits[25:] == 0).all()


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(3)
    groups = rng.permutation(64).reshape(4, 16)
    bits = np.zeros((4000, 64))
    for g in groups:
        bits[:, g] = rng.integers(0, 2, (4000, 1)) ^ (rng.random((4000, 16)) < 0.1)
    together = bits.T @ bits / len(bits)
    parts = simhash_dedup.correlated_parts(np.diag(together).copy(), together, 4)
    assert sorted(sorted(p) for p in parts) == sorted(sorted(g.tolist()) for g in groups)


def test_op12(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in QUERIES["op12_simhash_dedup"](spark, FOLDER).collect())
    assert got == sorted((i, f"{p:016x}", c) for i, p, c in print_groups(docs))


# --- the trie of conversations ----------------------------------------------


def in_order(rows):
    """Turns (role, text) of every conversation."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in found.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def nodes_of(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        words = len(brute.words(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children[node])
    return sorted(
        (m[0], len(n), -1 if not n else members[n[:-1]][0], len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in members.items()
    )


def got_nodes(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def talks(rng, n, longest=12):
    """Conversations that share beginnings, with nulls, ties and repeats."""
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            turn = None if rng.random() < 0.03 else t // 2 if c % 5 == 0 else t
            rows.append((c, turn, rng.choice(["user", "assistant", None]) if t > 2 else "user", rng.choice(["a b c", "hello there", None, ""]) if t > 1 else "hi you"))
    rows += rows[:7]
    rows += [(None, 1, "user", "nobody"), (1000, None, None, None)]
    rows += [(2000, t, "user", f"{t % 3} x") for t in range(600)] + [(2001, t, "user", f"{t % 3} x") for t in range(500)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bound", [10**6, 300, 20, 2])
def test_trie(spark, bound):
    rows = talks(random.Random(8), 60)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, id string").repartition(6)
    if bound == 2:
        df = df.where("conv_id IS NULL OR conv_id < 40 AND conv_id % 3 = 0")
    kept = [tuple(r)[:4] for r in df.collect()]
    assert got_nodes(ct.trie(df, bound=bound)) == nodes_of(in_order(kept))


def test_trie_of_nothing(spark):
    assert ct.trie(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_centroids_add_up_every_tree():
    rng = random.Random(6)
    for n in (1, 2, 3, 10, 200, 3000):
        for kind in ("chain", "star", "any"):
            parent = np.array([-1 if v == 0 or kind == "any" and rng.random() < 0.02 else {"chain": v - 1, "star": 0, "any": rng.randrange(v)}[kind] for v in range(n)])
            values, weight = np.array([[rng.randint(-5, 9) for _ in range(n)] for _ in range(2)]), np.array([rng.randint(1, 4) for _ in range(n)])
            sums = values.copy()
            for v in range(n - 1, -1, -1):
                if parent[v] >= 0:
                    sums[:, parent[v]] += sums[:, v]
                    weight[parent[v]] += weight[v]
            shuffled = np.array(rng.sample(range(n), n))
            back = np.argsort(shuffled)
            moved = np.where(parent[shuffled] >= 0, back[parent[shuffled]], -1)
            assert (ct.decompose(moved, weight[shuffled], values[:, shuffled]) == sums[:, shuffled]).all()


def test_op13(spark, tmp_path):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{FOLDER}/conversations.parquet'").fetchall()
    assert got_nodes(QUERIES["op13_conversation_trie"](spark, FOLDER)) == nodes_of(rebuilt(in_order(rows)))
    more = talks(random.Random(9), 90, 5)
    spark.createDataFrame(more, "conv_id bigint, turn bigint, role string, text string").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got_nodes(QUERIES["op13_conversation_trie"](spark, str(tmp_path))) == nodes_of(rebuilt(in_order(more)))
    few = spark.read.parquet(f"{tmp_path}/conversations.parquet").where(F.lit(False))
    few.write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert QUERIES["op13_conversation_trie"](spark, f"{tmp_path}/none").count() == 0
