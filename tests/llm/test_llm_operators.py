"""The numbered operators against plain Python versions, on a small sample of odd documents."""

from __future__ import annotations

import random

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlstone.llm import bpe, edits, language, line_dedup, near_dedup, packing, quality, secrets, textbytes, token_counts, url_filter
from marlstone.llm import fingerprints as fp
from marlstone.llm.grouping import components

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- 1 -----------------------------------------------------------------------


def test_line_dedup(docs, rows):
    got = by_id(line_dedup.clean(docs))
    want = brute.clean_lines([(r[0], r[1]) for r in rows])
    assert {i: r["text"] for i, r in got.items()} == {r[0]: t for r, t in zip(rows, want)}
    assert any(t != r[1] for r, t in zip(rows, want))
    assert list(next(iter(got.values())).asDict()) == docs.columns


def test_line_dedup_of_drifting_lines(spark):
    """Chains of small edits: near lines that are not near the head of their keys are still found."""
    rng = random.Random(11)
    lines, line = [], [f"word{k}" for k in range(30)]
    for _ in range(60):
        lines.append(" ".join(line))
        line = list(rng.choice(lines).split())
        for k in rng.sample(range(30), rng.randint(1, 2)):
            line[k] = "".join(rng.choices("abcdefgh", k=6))
    data = [(k, x) for k, x in enumerate(lines + lines[:20])]
    got = by_id(line_dedup.clean(spark.createDataFrame(data, "doc_id bigint, text string")))
    want = brute.clean_lines(data)
    assert [got[k]["text"] for k, _ in data] == want
    assert 20 < sum(not t for t in want) < 80


@settings(max_examples=500, deadline=None)
@given(st.text("ab é", max_size=24), st.text("ab é", max_size=24), st.integers(0, 12))
def test_edits_at_most(a, b, most):
    assert edits.edits_at_most(a, b, most) == (brute.levenshtein(a, b) <= most)


def test_many_pairs_at_a_time(monkeypatch):
    """Texts of many sizes, each pair as often near as far by a little."""
    rng = random.Random(1)
    texts = []
    for _ in range(150):
        text = "".join(rng.choices("ab cdé", k=rng.choice([1, 5, 20, 63, 64, 65, 127, 128, 129, 150, 200])))
        other = [rng.choice("abc 日") if rng.random() < 0.15 else c for c in text if rng.random() < 0.9]
        texts += [text, "".join(other) or "x"]
    x = np.array([*range(0, 300, 2), *(rng.randrange(300) for _ in range(200))])
    y = np.array([*range(1, 300, 2), *(rng.randrange(300) for _ in range(200))])
    far = np.array([brute.levenshtein(texts[i], texts[j]) for i, j in zip(x, y)])
    for few in (1, 10**9):
        monkeypatch.setattr(edits, "_FEW", few)
        for _ in range(4):
            most = np.maximum(0, far + np.array(rng.choices(range(-2, 3), k=len(far))))
            assert (edits.pairs_within(texts, x, y, most) == (far <= most)).all()
    long = [" ".join(rng.choices(["the", "of", "and", "tion", "ing"], k=700)) for _ in range(4)]
    long += [t.replace("tion", "tain", 40) for t in long]
    pairs = [(i, j) for i in range(8) for j in range(i)]
    x, y = np.array(pairs).T
    near = edits.pairs_within(long, x, y, np.full(len(x), 200))
    assert near.tolist() == [brute.levenshtein(long[i], long[j]) <= 200 for i, j in pairs] and 4 <= near.sum() < len(x)


def test_one_pair_works_on_what_is_in_reach(monkeypatch):
    """Numbers as long as the way may leave the diagonal, not as the text; the answer turns at the real distance."""
    sizes, look = [], edits._too_far
    monkeypatch.setattr(edits, "_too_far", lambda up, down, size, *rest: sizes.append(size) or look(up, down, size, *rest))
    rng = random.Random(8)
    for n, most in ((1500, 60), (3000, 300)):
        a = "".join(rng.choices("abcdé", k=n))
        b = list(a)
        for k in rng.sample(range(0, n, 4), most - 3):
            b[k] = "z"
        for moved in ("".join(b) + "zzz", "zzz" + "".join(b), "".join(b)[3:]):
            assert edits.edits_at_most(a, moved, most) and not edits.edits_at_most(a, moved, most - 1)
            assert edits.edits_at_most(moved, a, most) and not edits.edits_at_most(moved, a, most - 1)
    assert 0 < len(sizes) and max(sizes) < 700


def test_many_pairs_with_shifted_parts(monkeypatch):
    """Pairs of unlike sizes, whose way leaves the diagonal as far as it may."""
    monkeypatch.setattr(edits, "_FEW", 0)
    rng = random.Random(9)
    texts = []
    for _ in range(120):
        a = "".join(rng.choices("abc ", k=rng.choice([60, 64, 130, 200, 260])))
        cut, more = rng.randint(0, len(a) // 4), "".join(rng.choices("abc", k=rng.randint(0, len(a) // 4)))
        texts += [a, rng.choice([a[cut:], a[cut:] + more, more + a[: len(a) - cut], more + a])]
    x = np.arange(0, len(texts), 2)
    far = np.array([brute.levenshtein(texts[i], texts[i + 1]) for i in x])
    for d in (-1, 0, 1):
        most = np.maximum(far + d, 0)
        assert (edits.pairs_within(texts, x, x + 1, most) == (far <= most)).all()


def test_smallest_keys_whose_first_bits_agree():
    line = np.repeat(np.arange(3), 6)
    keys = np.tile(np.array([1 << 40 | 5, 7, 1 << 40 | 3, 1 << 40 | 5, 9, 1 << 40 | 3], dtype=np.uint64), 3)
    got = line_dedup._smallest(line, keys, 3)
    assert got[0].tolist() == [0, 0, 0, 1, 1, 1, 2, 2, 2] and got[1].tolist() == [7, 9, 1 << 40 | 3] * 3


def test_line_dedup_odd(odd, nothing):
    assert line_dedup.clean(odd, count="gone").count() == odd.count()
    assert line_dedup.clean(nothing).count() == 0


def test_line_simhash_counters_do_not_overflow():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 70_000, dtype=np.uint64)
    bounds = np.array([0, 66_000, 66_000, 70_000])
    got = textbytes.simhash(hashes, bounds)
    for k in range(3):
        own = hashes[bounds[k] : bounds[k + 1]]
        want = sum(1 << b for b in range(64) if 2 * int((own >> np.uint64(b) & np.uint64(1)).sum()) > len(own))
        assert int(got[k]) == want


# --- 2 -----------------------------------------------------------------------


def test_bpe_equals_tiktoken(odd, tik):
    encoded = bpe.encode(odd, RANKS, text="text").select("doc_id", "ids", "starts", "stops", F.col("ids").alias("again"))
    out = bpe.decode(encoded, RANKS).withColumnRenamed("again", "ids").collect()
    texts = sorted(r["text"] or "" for r in odd.collect())
    assert sorted(r["decoded"].decode() for r in out) == texts
    assert sorted(r["decoded_text"] for r in out) == texts
    for r in out:
        text = r["decoded"].decode()
        assert r["ids"] == tik.encode_ordinary(text)
        at = 0
        for i, a, b in zip(r["ids"], r["starts"], r["stops"]):
            piece = tik.decode_single_token_bytes(i)
            before = len(text.encode()[:at].decode("utf-8", "ignore"))
            assert a == before
            at += len(piece)
            assert b == len(text.encode()[:at].decode("utf-8", "replace"))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("aA1 .'\n\t\x1c\x85\xa0é𝛼!", max_size=80))
def test_bpe_any_text(text):
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}) if not hasattr(test_bpe_any_text, "tik") else test_bpe_any_text.tik
    test_bpe_any_text.tik = tik
    ids, bounds = bpe.coder(RANKS).encode([text, "", text])
    assert ids[: bounds[1]].tolist() == tik.encode_ordinary(text) == ids[bounds[2] :].tolist()
    assert bpe.byte_table(RANKS).decode(ids, bounds).to_pylist() == [text.encode(), b"", text.encode()]


def test_bpe_split_characters():
    own = bpe.coder(RANKS)
    assert len({*bpe.byte_alphabet()}) == 256
    out = bpe.byte_table(RANKS).decode(np.array([own.encode(["日"])[0][0]]), np.array([0, 1])).to_pylist()[0]
    assert "日".encode().startswith(out)


def test_bpe_forgets_when_full(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBER", 1)
    own = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    one, two = own.encode(["some words"])[0], own.encode(["other words", "some words"])
    assert two[0][two[1][1] :].tolist() == one.tolist()


# --- 3 -----------------------------------------------------------------------


def test_fingerprints(docs, rows):
    got = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(docs, ["doc_id"]).collect()}
    for r in rows:
        want = brute.fingerprint(r[1])
        assert got[r[0]] == want - (want >> 63 << 64)


def test_next_document(odd):
    rows = sorted([(-(2**63) if r["doc_id"] is None else r["doc_id"], __import__("hashlib").md5((r["text"] or "").encode()).hexdigest(), r["text"] or "") for r in odd.collect()])
    want = sorted((a[0], a[2], rows[k - 1][2]) for k, a in enumerate(rows))
    for buckets in (1, 3, 40):
        got = fp.with_next(odd, buckets=buckets)
        assert sorted((r["__id"], r["text"], r["next_text"]) for r in got.collect()) == want


def test_near_finds_every_pair(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = {*base} | {b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in range(1, 6)}
    signed = [p - (p >> 63 << 64) for p in prints]
    df = spark.createDataFrame([(p,) for p in [*signed, None, signed[0]]], "fingerprint bigint")
    for radius, spare in ((3, 2), (5, 1)):
        got = {(r["query"], r["found"]) for r in fp.near(df, df, radius, spare).collect()}
        assert got == {(a, b) for a in signed for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= radius}


def test_fingerprints_of_nothing(nothing):
    assert fp.fingerprints(nothing, ["doc_id"]).count() == 0 == fp.with_next(nothing).count()


# --- 4 -----------------------------------------------------------------------


def test_token_counts(odd, nothing):
    library = Tokenizer.from_file(WORDS)
    texts = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    want = sorted((str(i), len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts)
    for table in (None, {}):
        got = token_counts.count(odd, WORDS, table=table)
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got.collect()) == want
    assert token_counts.count(nothing, WORDS).count() == 0


def test_latin_pieces_are_the_librarys():
    library = Tokenizer.from_file(WORDS)
    marks = [chr(c) for c in range(0x250)]
    texts = [f"a{c}b {c}{c}1 '{c}s'S {c}" for c in marks] + ["It's WE'LL <|endoftext|> x", "İstanbul ΑΣ ς", "ﬁ ½ x²"]
    for text in texts:
        cut = token_counts.pieces(text, WORDS)
        if cut is not None:
            assert sum(len(library.encode(p, add_special_tokens=False).ids) for p in cut) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


# --- 5 -----------------------------------------------------------------------


def test_figures(docs, rows):
    got = by_id(quality.figures(docs))
    for r in rows:
        want = brute.figures(r[1])
        assert {k: got[r[0]][k] for k in want} == want


def test_quality_model(docs, nothing, odd):
    voted = quality.vote(quality.figures(docs))
    model = quality.fit(voted)
    names = [n for n in model if n != "good"]
    judged = by_id(quality.judge(docs))
    for r in judged.values():
        assert abs(r["quality"] - quality.posterior(model, {n: r[n] for n in names})) < 1e-9
        assert r["good"] == (r["quality"] >= 0.5)
    assert all(0 < a <= 1 for a in quality.accuracies(model).values())
    assert quality.judge(nothing).count() == 0 and quality.fit(quality.vote(quality.figures(nothing)))["good"] == quality.GOOD
    carried = quality.judge(odd, carry=True).select("row.*")
    assert carried.columns == odd.columns and carried.count() == odd.count()


def test_quality_against_labels(spark):
    """Long enough documents are called good or bad as they are labelled."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    judged = quality.judge(spark.read.parquet(f"{folder}/documents.parquet")).where("n_words >= 50").join(labels, "doc_id")
    rows = judged.select("good", "label").collect()
    assert len(rows) > 300 and all(r["good"] == (r["label"] == 1) for r in rows)


# --- 6 -----------------------------------------------------------------------


def test_best_fit_is_the_tightest():
    rng = random.Random(5)
    for _ in range(30):
        lengths = sorted((rng.randint(0, 100) for _ in range(80)), reverse=True)
        masks = [1 << rng.randint(0, 5) if rng.random() < 0.8 else 0 for _ in lengths]
        assert packing.best_fit(lengths, masks, 100) == brute.best_fit(lengths, masks, 100)


@pytest.mark.parametrize("shard", [7, 1000])
def test_packing(odd, nothing, shard):
    items = odd.select("doc_id", F.size(F.split("text", " ")).alias("length"), "source", F.xxhash64("text").alias("cluster"))
    got = packing.pack(items, 100, shard).collect()
    whole = sorted((str(r["doc_id"]), max(r["length"] or 0, 0)) for r in items.withColumn("length", F.coalesce("length", F.lit(0))).collect())
    pieces = {}
    for r in got:
        key = (r["doc_id"], r["cluster"], r["copy"])
        pieces.setdefault(key, []).append((r["start"], r["length"]))
    sums = []
    for (i, _, _), parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        sums.append((str(i), at))
    assert sorted(sums) == whole
    bins = {}
    for r in got:
        bins.setdefault(r["bin_id"], []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: (r["position"], r["length"]))
        assert sum(r["length"] for r in own) <= 100
        assert all(a["position"] + a["length"] == b["position"] for a, b in zip(own, own[1:]))
        sources = [r["source"] for r in own if r["source"] is not None]
        clusters = [r["cluster"] for r in own]
        assert len(set(sources)) == len(sources) and len(set(clusters)) == len(clusters)
    assert packing.pack(nothing.select("doc_id", F.lit(1).alias("length"), "source", F.lit(1).alias("cluster"))).count() == 0


# --- 7 -----------------------------------------------------------------------


def test_language_pair_tables_equal_the_network():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 256, (40, language.WINDOW), dtype=np.uint8)
    net = language.train(x, rng.integers(0, 3, 40), ("a", "b", "c"), steps=3)
    plain = np.concatenate([language._responses(x, net.filters[w]).max(axis=1) for w in language.WIDTHS], axis=1)
    assert np.allclose(language.Reader(net).responses(x), np.maximum(plain, 0) @ net.dense + net.bias, atol=1e-4)


def test_language_windows_cover_texts():
    texts = [b"", b"a" * 5, b"b" * 600, b"", b"c" * language.WINDOW]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    x, text_of = language.windows(data, offsets)
    for k, t in enumerate(texts):
        assert x[text_of == k].tobytes().rstrip(b" ") == t
    net = language.train(x, text_of % 2, ("a", "b"), steps=3)
    reader = language.Reader(net)
    whole = reader.scores(data, offsets)
    small = np.concatenate([reader.scores(data[a:b], np.array([0, b - a])) for a, b in zip(offsets[:-1], offsets[1:])])
    assert np.allclose(whole, small)
    assert list(language._stretches(offsets, 256)) == [(0, 5), (5, 261), (261, 517), (517, 605), (605, 861)]


def test_language_edges(odd, nothing, spark):
    net = language.fit(odd.select("text", "lang"))
    got = language.predict(odd, net)
    for r in got.join(odd.select("doc_id", "text").distinct(), "doc_id").collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        if not letters:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert 0 <= r["score"] <= 1
    empty = language.fit(nothing.select("text", "lang"))
    assert {r["lang_pred"] for r in language.predict(odd, empty).collect()} == {"und"}
    assert language.predict(nothing, net).count() == 0


def test_training_rows_are_different_windows(spark):
    """Copies of a text do not take the places of other texts."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(120)) for _ in range(300)]
    rows = [(t, "xx") for t in texts] + [(texts[0], "xx")] * 3000 + [("short text", "yy"), ("12 34", "yy"), (None, "yy"), ("no label", None)]
    got = language.training_rows(spark.createDataFrame(rows, "text string, lang string").repartition(6), 200).collect()
    parts = [r["part"] for r in got if r["lang"] == "xx"]
    assert len(parts) == 200 == len(set(parts)) and len({t for t in texts for p in parts if p in t}) > 80
    assert {r["part"] for r in got if r["lang"] == "yy"} <= {"short text"[k:] for k in range(10)}


def test_language_query_by_plain_windows(spark):
    """Every prediction again: whole windows of the bytes, plain filters, the shares of their mean."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").limit(60)
    net = language.fit(docs.select("text", "lang"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in language.predict(docs, net).collect():
        data = np.frombuffer(texts[r["doc_id"]].encode(), np.uint8)
        x, _ = language.windows(data, np.array([0, len(data)]))
        plain = np.concatenate([language._responses(x, net.filters[w]).max(axis=1) for w in language.WIDTHS], axis=1)
        mean = (np.maximum(plain, 0) @ net.dense + net.bias).mean(axis=0)
        want = np.exp(mean - mean.max()) / np.exp(mean - mean.max()).sum()
        if any(c.isalpha() for c in texts[r["doc_id"]]):
            assert r["score"] == pytest.approx(want.max(), abs=1e-3) and want[net.languages.index(r["lang_pred"])] == pytest.approx(want.max(), abs=1e-3)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    net = language.fit(docs.where(learned).select("text", "lang"))
    told = language.predict(docs.where(~learned), net).join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in told)
    assert len(told) > 200 and right >= 0.98 * len(told)


# --- 8 -----------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("a.example.com", "/", "allow"), ("org", "/fr/", "allow"), ("org", "/fr/", "block")]
URLS = [None, "", "x", "http://", "http://net/", "HTTP://WWW.Example.NET/en/1?q#f", "http://example.net/en", "https://example.net?x=/en/", "ftp://b.example.com/de/x", "http://a.example.com/de/x",
        "http://notnet/", "http://é.net/ü", "http://x.org/fr/1", "//x.org/fr/", "a://b://net/", "http://example.com\n.net/de/\n"]


@pytest.mark.parametrize("same_digest", [False, True])
def test_url_rules(tmp_path, monkeypatch, same_digest):
    if same_digest:
        monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda t: 7)
    own = url_filter.DigestList(url_filter.write_list(RULES, str(tmp_path)))
    parts = [brute.url_parts(u) for u in URLS]
    got = [(t, url_filter.BLOCK if b else url_filter.ALLOW) for t, b in own.fits(*map(list, zip(*parts)))]
    assert got == [brute.url_rule(h, p, [r for r in RULES if r != ("org", "/fr/", "allow")]) for h, p in parts]


def test_url_judge(spark):
    pages = spark.createDataFrame([(k, u, "h", "p") for k, u in enumerate(URLS)], "page_id bigint, url string, host string, rule string")
    got = url_filter.judge(pages, url_filter.publish(spark, RULES[:4])).orderBy("page_id").collect()
    for r, u in zip(got, URLS, strict=True):
        host, path = brute.url_parts(u)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, *brute.url_rule(host, path, RULES[:4]))
    none = url_filter.judge(pages, url_filter.publish(spark, []))
    assert {r["verdict"] for r in none.collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), url_filter.publish(spark, RULES)).count() == 0


# --- 9 -----------------------------------------------------------------------


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, rows, width):
    want, sizes = brute.near_groups({r[0]: r[1] for r in rows}, width)
    got = by_id(near_dedup.groups(docs, width=width))
    assert {i: (r["component_id"], r["n_shingles"], r["kept"]) for i, r in got.items()} == {i: (c, sizes[i], c == i) for i, c in want.items()}
    assert len(set(want.values())) < len(want)


def test_near_duplicates_chain_through_failing_head(spark):
    """a~b, b~c, c~d, while a, the head of the shared buckets, is like b only."""
    words = [f"w{k}" for k in range(100)]
    texts = [words, words[:-6] + [f"b{k}" for k in range(6)], words[6:-6] + [f"b{k}" for k in range(6)] + [f"c{k}" for k in range(6)], ["z"] * 3]
    texts.append([f"d{k}" for k in range(6)] + texts[2][6:])
    data = {k: " ".join(t) for k, t in enumerate(texts)}
    want, _ = brute.near_groups(data, 1)
    got = by_id(near_dedup.groups(spark.createDataFrame([*data.items()], "doc_id bigint, text string"), width=1))
    assert {i: r["component_id"] for i, r in got.items()} == want


def test_near_duplicates_odd(odd, nothing, rows):
    got = near_dedup.groups(odd).collect()
    assert len(got) == odd.count()
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert near_dedup.groups(nothing).count() == 0
    kept = near_dedup.thin(odd)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None]
    assert len(ids) == len(set(ids)) and kept.columns == odd.columns
    assert kept.where("doc_id IS NULL").count() == 2


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 90), (100, 95), (90, 200), (7, 7)]
    random.Random(2).shuffle(edges)
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == brute.components({i for e in edges for i in e}, edges)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_long_words_and_block_edges():
    """Words around the edges of the blocks hash like the same words alone."""
    long = b"q" * (textbytes.BLOCK + 5)
    texts = [b"ab " * (textbytes.BLOCK // 3 + 2), b"", long + b" ab", b"ab", b" ".join([b"x", long]), b"ab"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    table, fold = textbytes.table(textbytes.BLANKS), textbytes.lower_ascii()
    starts, ends, hashes = textbytes.word_hashes(data, offsets, table, fold)
    bounds = textbytes.per_text(starts, offsets)
    for k, t in enumerate(texts):
        own = hashes[bounds[k] : bounds[k + 1]]
        assert len(own) == len(t.split())
        assert [bytes(data[a:b]) for a, b in zip(starts[bounds[k] : bounds[k + 1]], ends[bounds[k] : bounds[k + 1]])] == t.split()
    ab = hashes[0]
    assert (hashes[bounds[0] : bounds[1]] == ab).all() and hashes[bounds[2] + 1] == ab == hashes[bounds[3]] == hashes[bounds[5]]
    assert hashes[bounds[2]] == hashes[bounds[4] + 1]


# --- 10 ----------------------------------------------------------------------


def test_secret_spans(odd, nothing):
    got = secrets.find(odd, carry=True).select("row.text", "base", "spans", secrets.redacted(F.coalesce("row.text", F.lit("")), F.col("spans")).alias("clean")).collect()
    added = 0
    for r in got:
        assert [tuple(s) for s in r["base"]] == brute.base_spans(r["text"])
        spans = brute.all_spans(r["text"], secrets)
        assert [tuple(s) for s in r["spans"]] == spans
        assert r["clean"] == brute.redact(r["text"] or "", spans)
        added += len(spans) - len(r["base"])
    assert added > 0 and secrets.find(nothing).count() == 0


def test_secret_patterns_on_hard_texts(spark):
    texts = ['token= "secret: abcdefghij', "token==abcdefgh token=short password:x", "PassWord = 'Abc.def/ghi' 😀 api_key:AAAAAAAAA", "AKIAAKIA12 AKIA123456789012 xAKIAAAAAAAAAAAAAAAA",
             "0" * 31 + " " + "0" * 32 + "g" + "a1" * 40, "passwd\"  :   'abcdefgh=='", "é" * 3 + "secret=12345678"]
    got = secrets.find(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        assert [tuple(s) for s in r["base"]] == brute.base_spans(t), t


def test_window_entropy(spark):
    rng = random.Random(4)
    strings = ["".join(rng.choices(alphabet, k=n)) for alphabet in ("ab", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABC0123456789+/") for n in (1, 19, 20, 21, 64)]
    got = spark.createDataFrame([(s,) for s in strings], "s string").select("s", secrets.window_entropy(F.col("s")).alias("e")).collect()
    for r in got:
        assert abs(r["e"] - brute.most_entropy(r["s"], secrets.WINDOW)) < 1e-9
