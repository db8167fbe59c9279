"""Periodic runs, token files and whitening against brute force and round trips, on rows with every odd case."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow.orc
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelstat.llm import periodic, token_files, whitening
from reelstat.session import scratch_path
from tests.llm.conftest import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = public_tokenizers.path(token_files.VOCABULARY)


def runs_of(words):
    """(start, length, period) of every run, period by period."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    x = np.array([numbers[w] for w in words], np.int64)
    least = {}
    for q in range(1, len(x) // 4 + 1):
        change = np.diff(np.concatenate([[0], x[:-q] == x[q:], [0]]).astype(int))
        for a, b in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()):
            if b + q - a >= max(6, 4 * q):
                least.setdefault((a, b + q), q)
    return sorted((a, b - a, q) for (a, b), q in least.items())


def collapsed(words, runs):
    dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_runs_of_random_words():
    rng = random.Random(4)
    for _ in range(150):
        docs = []
        for _ in range(rng.randrange(1, 6)):
            kinds = rng.choice([1, 2, 3, 5, 50])
            words = [rng.randrange(kinds) for _ in range(rng.randrange(120))]
            for _ in range(rng.randrange(4)):
                period = [rng.randrange(kinds) for _ in range(rng.randrange(1, 30))]
                again = period * rng.randrange(2, 9)
                at = rng.randrange(len(words) + 1)
                words[at:at] = again[: len(again) - rng.randrange(len(period))]
            docs.append(words)
        bounds = np.cumsum([0] + [len(d) for d in docs])
        begin, end, period = periodic.find_runs(np.array([w for d in docs for w in d], np.int64), bounds)
        found = list(zip(begin.tolist(), (end - begin).tolist(), period.tolist()))
        assert found == [(int(b) + a, n, q) for b, d in zip(bounds, docs) for a, n, q in runs_of(d)]


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_transform_finds_every_recurrence(size):
    rng = np.random.default_rng(size)
    numbers = rng.integers(0, 3, 400)
    numbers[200:300] = numbers[100:200]
    numbers = np.concatenate([numbers * 1_000_003, np.zeros(3 * size, np.int64)])
    blocks = np.arange(0, 400 - 2 * size, size)
    found = set(zip(*map(np.ndarray.tolist, periodic.recurrences(numbers, blocks, size))))
    wanted = {
        (int(b), d)
        for b in blocks
        for d in range(size, 2 * size)
        if (numbers[b : b + size] == numbers[b + d : b + d + size]).all()
    }
    assert found == wanted


def test_long_texts_of_few_words():
    for words in ([7] * 100_000, [1, 2, 3] * 30_000):
        begin, end, period = periodic.find_runs(np.array(words), np.array([0, len(words)]))
        assert (begin.tolist(), end.tolist(), period.tolist()) == ([0], [len(words)], [len(set(words))])


def test_periodic_runs_of_documents(documents):
    found = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(documents).collect()), key=repr)
    wanted = []
    for doc, text, *_ in corpus():
        words = WORD.findall(text or "")
        wanted.append((doc, runs_of(words), collapsed(words, runs_of(words))))
    assert found == sorted(wanted, key=repr)
    assert any(runs for _, runs, _ in found)


def test_planted_ends(spark, documents):
    rows = documents.select("doc_id", "text", periodic.planted(F.col("doc_id"), F.col("text")).alias("new")).collect()
    changed = 0
    for r in rows:
        words = WORD.findall(r.text or "")
        h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        if h % 10 or not words:
            assert r.new == r.text
            continue
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert r.new == " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
        changed += 1
    assert changed > 3


def test_periodic_query(spark, documents, tmp_path):
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    for r in periodic.op11_periodic(spark, str(tmp_path)).collect():
        if r.n_runs == 0:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
            assert r.runs_sha256 == hashlib.sha256(b"").hexdigest()
        else:
            assert r.exponent_milli == 1000 * r.length // r.period
        assert len(r.collapsed_sha256) == 64


def ids_of(text):
    return Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids + [1]


def test_words_encode_like_texts():
    rng = random.Random(9)
    parts = ["don't", "İstanbul", "ΑΣ", "日本語", "é", " ", "\x00", "a\x00b", "<|endoftext|>", "x<|startoftext|>y"]
    parts += ["ﬁ", " ", "42nd", "--", "!!\x00", "\x1c", "naïve", "𝔘𝔫𝔦"]
    texts = [rng.choice([" ", "\n", "\t\t", "\r\n"]).join(rng.choices(parts, k=rng.randrange(0, 12))) for _ in range(300)]
    texts += ["".join(rng.choices(parts, k=6)) for _ in range(100)] + [None, "", " "]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    import pyarrow as pa

    for _ in range(2):  # words met before and not
        flat, counts = token_files.encode(VOCABULARY, pa.array(texts, pa.string()))
        found = np.split(flat, np.cumsum(counts)[:-1])
        for text, ids in zip(texts, found):
            assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_token_files_round_trip(spark, documents):
    folder = scratch_path(spark, "ids")
    token_files.write_ids(documents, folder, VOCABULARY)
    rows = token_files.read_ids(spark, folder).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((c[0] for c in corpus()), key=lambda d: (d is not None, d))
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    wanted = sorted((c[0] is not None, c[0], ids_of(c[1])) for c in corpus() if c[0] is not None)
    assert sorted((True, r.doc_id, r.ids) for r in rows if r.doc_id is not None) == wanted
    sums = {(r.doc_id, r.start): r for r in token_files.checked(spark, folder).collect()}
    for r in rows:
        assert sums[r.doc_id, r.start].ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def scanned(frame):
    """Rows that the scans of an executed frame gave out."""
    frame.collect()
    plan, total = frame._jdf.queryExecution().executedPlan(), 0
    leaves = plan.collectLeaves()
    for k in range(leaves.size()):
        node = leaves.apply(k)
        if hasattr(node, "metrics") and node.metrics().contains("numOutputRows"):
            total += node.metrics().apply("numOutputRows").value()
    return total


def test_reads_by_id_leave_row_groups_out(spark):
    many = spark.range(0, 40_000, 2).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text")).repartition(4)
    folder = scratch_path(spark, "ids")
    token_files.write_ids(many, folder, VOCABULARY)
    name = spark.read.orc(f"{folder}/ids").inputFiles()[0].removeprefix("file://").removeprefix("file:")
    assert pyarrow.orc.ORCFile(name).nstripes >= 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = spark.read.schema(token_files.ROW).orc(f"{folder}/ids")
        present = scanned(plain.filter("doc_id = 20000"))
        absent = scanned(plain.filter("doc_id = 20001"))
        all_rows = scanned(plain.filter("doc_id >= 0"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert all_rows == 20_000
    # One row group of one file; the Bloom filters know an id inside the range that no row has.
    assert 0 < present <= token_files.INDEX_ROWS
    assert absent == 0


def test_empty_tables(spark, nothing):
    assert periodic.periodic_runs(nothing).count() == 0
    folder = scratch_path(spark, "ids")
    token_files.write_ids(nothing, folder, VOCABULARY)
    assert token_files.checked(spark, folder).count() == 0
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whitened_rows(none).count() == 0


VECTORS = "vec_id long, embedding array<double>, label int, dims int, `key` string"


def vectors(n=300, dims=20, seed=2):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, dims)) * np.linspace(0.2, 4, dims)
    rows[n // 2 :] = rows[3]
    return rows


def truth(x, weights, k=16):
    n = weights.sum()
    mean = (weights[:, None] * x).sum(axis=0) / n
    centred = x - mean
    covariance = centred.T @ (weights[:, None] * centred) / n
    values, axes = np.linalg.eigh(covariance)
    return n, values[::-1][:k], axes[:, ::-1][:, :k], mean, np.trace(covariance)


@pytest.mark.parametrize("weighted", [False, True])
def test_whitening(spark, weighted):
    own = vectors()
    rows = [(k, v.tolist(), 0, 9, "x") for k, v in enumerate(own)] + [(None, own[0].tolist(), 0, 9, "x")]
    odd = [None, [], [1.0, None], [float("nan")] * 20, [float("inf")] + [0.0] * 19]
    frame = spark.createDataFrame(rows + [(900 + k, v, 0, 9, "x") for k, v in enumerate(odd)], VECTORS).repartition(3)
    found = whitening.whitened_rows(frame, weighted=weighted).collect()
    x = np.floor(64 * np.array([r[1] for r in rows])).astype(np.int64) + 1_000_000
    distinct, counts = np.unique(x, axis=0, return_counts=True)
    n, values, axes, mean, trace = truth(distinct, counts if weighted else np.ones_like(counts))
    sums = (distinct * (counts if weighted else np.ones_like(counts))[:, None]).sum(axis=0)
    white = np.abs((x - mean) @ axes / np.sqrt(values))
    assert len(found) == 16 * len(rows)
    for r in found:
        at = len(own) if r.vec_id is None else r.vec_id
        assert r.n == n
        assert r.deviation == sum((int(n) * int(a) - int(s)) ** 2 for a, s in zip(x[at], sums))
        assert math.isclose(abs(r.whitened), white[at, r.component - 1], rel_tol=1e-6, abs_tol=1e-8)
        assert math.isclose(r.explained, values[r.component - 1] / trace, rel_tol=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_of_degenerate_and_extreme_vectors(spark):
    rows = [(k, [5.0, 5.0], 0, 0, "") for k in range(4)]  # one distinct vector: no spread
    rows += [(10 + k, [float(k), 2.0 * k, 1.0], 0, 0, "") for k in range(5)]  # rank one
    rows += [(20, [1e300, 0.0, 0.0, 0.0], 0, 0, ""), (21, [-1e300, 0.0, 0.0, 1.0], 0, 0, ""), (22, [0.0] * 4, 0, 0, "")]
    found = whitening.whitened_rows(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r.vec_id, r.component) for r in found if r.vec_id < 20) == [(10 + k, 1) for k in range(5)]
    line = [r for r in found if 10 <= r.vec_id < 20]
    assert all(math.isclose(r.explained, 1) and r.n == 5 for r in line)
    extreme = [r for r in found if r.vec_id >= 20]
    assert {r.vec_id for r in extreme} == {20, 21, 22}
    assert all(math.isfinite(r.whitened) for r in extreme)
    assert [r.deviation for r in extreme if r.vec_id == 20] == [None] * len([r for r in extreme if r.vec_id == 20])
