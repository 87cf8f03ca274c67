"""The registered queries and the pipeline on the smallest tables, against plain Python."""

from __future__ import annotations

import zlib

import brute
import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marlstone.llm import bpe, packing, quality, secrets
from marlstone.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given():
    return duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, name):
    return sorted((r.asDict() for r in QUERIES[name](spark, FOLDER).collect()), key=lambda r: r["doc_id"])


def test_all_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_op1(spark, given):
    got = rows(spark, "op1_line_dedup")
    check_lines([(r[0], r[1]) for r in given], [r["text"] for r in got])
    for r, (_, text, *_) in zip(got, given):
        assert r["n_lines"] == text.count("\n") + 1
        if r["n_removed"] < r["n_lines"]:
            assert r["n_removed"] == r["n_lines"] - r["text"].count("\n") - 1


def check_lines(docs, texts):
    """Whole lines went, only such as plain edit similarity takes out, and nearly all of those."""
    found = wanted = 0
    for (_, before), after, all_gone in zip(docs, texts, brute.clean_lines(docs), strict=True):
        out, whole = brute.lines_out(before, after)
        more, left = brute.lines_out(before, all_gone)
        assert whole and left and brute.lines_out(after, all_gone)[1]
        found, wanted = found + out, wanted + more
    assert found >= 0.97 * wanted


def test_op2(spark, given):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r, (_, text, *_) in zip(rows(spark, "op2_byte_bpe"), given, strict=True):
        ids = tik.encode_ordinary(text)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text))


def test_op3(spark, given):
    prints = [brute.fingerprint(r[1]) for r in given]
    got = rows(spark, "op3_fingerprints")
    for k, r in enumerate(got):
        text, after = given[k][1], given[k - 1][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        like = lambda a, b: 1 - (a ^ b).bit_count() / 64
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"]) == (len(text), brute.sha(edited), f"{prints[k]:016x}")
        assert r["edited_fingerprint"] == f"{brute.fingerprint(edited):016x}"
        assert (r["near_edited"], r["near_next"]) == (like(prints[k], brute.fingerprint(edited)), like(prints[k], prints[k - 1]))
        near = sum((prints[k] ^ p).bit_count() <= 3 for p in prints) - 1
        assert r["near_docs"] == (near if r["doc_id"] % 100 == 0 else None)


def test_op4(spark, given):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r, (_, text, *_) in zip(rows(spark, "op4_token_counts"), given, strict=True):
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_op6(spark, given):
    check_bins(QUERIES["op6_best_fit_packing"](spark, FOLDER).collect(), [(r[0], r[1], r[3]) for r in given])


def check_bins(got, docs):
    """All words are in a bin; in one shard, the bins are those of the plain search."""
    lengths = {i: len(brute.words(t)) for i, t, _ in docs}
    sums = dict.fromkeys(lengths, 0)
    for r in got:
        sums[r["doc_id"]] += r["length"]
    assert sums == lengths
    rest = sorted((r for r in got if not r["bin_id"].startswith("full")), key=lambda r: (-r["length"], r["doc_id"], r["cluster"], r["copy"]))
    source, cluster = packing._bits([r["source"] for r in rest]), packing._bits([r["cluster"] for r in rest])
    width = max(m.bit_length() for m in source)
    placed = brute.best_fit([r["length"] for r in rest], [a | b << width for a, b in zip(source, cluster)], packing.CAPACITY)
    assert [(r["bin_id"], r["position"]) for r in rest] == [(f"0:{b}", p) for b, p in placed]


def test_op7(spark, given):
    got = rows(spark, "op7_language_id")
    for r, (i, text, *_) in zip(got, given, strict=True):
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text))
    held = [(r["lang_pred"], g[2]) for r, g in zip(got, given) if r["held_out"] and g[2]]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_op10(spark, given):
    for r, (_, text, *_) in zip(rows(spark, "op10_secret_scan"), given, strict=True):
        base = brute.base_spans(text)
        spans = brute.all_spans(text, secrets)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for _, k, _ in base) for x in range(3)]
        assert (r["base_sha256"], r["spans"]) == (brute.sha(brute.digest(base, secrets.KINDS)), brute.digest(spans, secrets.KINDS))


# --- the pipeline ------------------------------------------------------------


def expected(stage, kept):
    """(id, text, source) after one of the first four stages; None after that of lines, which has a test of its own."""
    if stage == "quality_rules" and kept:
        votes = []
        for _, t, _ in kept:
            figure = brute.figures(t)
            vote = lambda x: bool(eval(x.replace("AND", "and").replace("OR", "or"), {}, figure))  # noqa: E731, S307, B023
            votes.append(tuple(-1 if vote(r.bad) else int(vote(r.good)) for r in quality.RULES))
        good = brute.posteriors(votes, quality.START, quality.GOOD, quality.WEIGHT, quality.ROUNDS)
        return [d for d, v in zip(kept, votes) if good[v] >= 0.5 and brute.words(d[1])]
    if stage == "line_dedup":
        return None
    if stage == "minhash_near_dedup":
        label, _ = brute.near_groups({i: t for i, t, _ in kept}, 5)
        return [d for d in kept if label[d[0]] == d[0]]
    return [(i, brute.redact(t, brute.all_spans(t, secrets)), s) for i, t, s in kept]


@pytest.mark.parametrize("small", [True, False])
def test_pipeline_stages(spark, tmp_path, docs, given, small):
    whole = docs if small else spark.read.parquet(f"{FOLDER}/documents.parquet")
    plain = sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect())) if small else given
    now, kept = whole, [(r[0], r[1], r[3]) for r in plain]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, now, FOLDER).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        assert now.columns == whole.columns
        got = sorted((r["doc_id"], r["text"], r["source"]) for r in now.collect())
        want = expected(name, kept)
        if want is None:
            after = {i: t for i, t, _ in got}
            check_lines([d[:2] for d in kept], [after.get(i, "") for i, _, _ in kept])
            assert all(brute.words(t) for t in after.values())
            assert [(i, s) for i, _, s in got] == [(i, s) for i, _, s in sorted(kept) if i in after]
        else:
            assert got == sorted(want), name
        assert now.where(F.col("n_chars") != F.length("text")).isEmpty()
        kept = got
    check_bins(corpus_pipeline.STAGES[-1][1](spark, now, FOLDER).collect(), kept)


def test_pipeline_on_odd_rows(spark, tmp_path, odd, nothing):
    for k, now in enumerate((odd, nothing)):
        count = now.count()
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, now, FOLDER).write.parquet(f"{tmp_path}/{k}-{name}")
            now = spark.read.parquet(f"{tmp_path}/{k}-{name}")
        assert now.count() == 0 if not count else now.count() > 0


def test_pipeline_run(spark):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
