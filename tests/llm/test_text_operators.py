"""Operators on texts against brute force, on rows with every odd case."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelstat.llm import mixing, neardup, packing, rules, sharding, substrings
from reelstat.session import scratch_path
from tests.llm.conftest import SCHEMA, corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_packing_places_every_id_once(documents):
    rows = packing.pack(documents, PATH).collect()
    pieces = collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        pieces[r.doc_id].append(r)
    wanted = collections.Counter()
    for (doc, *_), ids in zip(corpus(), ids_of([c[1] for c in corpus()])):
        wanted[doc, tuple(ids)] += 1
    found = collections.Counter()
    for doc, own in pieces.items():
        # Copies of a repeated row are told apart by their order in the stream.
        own.sort(key=lambda r: (r.sequence_id, r.offset))
        current = []
        for r in own:
            assert r.start == len(current) % r.doc_tokens if r.start else True
            current += np.frombuffer(r.ids, "<u4").tolist()
            if len(current) == r.doc_tokens:
                found[doc, tuple(current)] += 1
                current = []
        assert not current
    assert found == wanted


def test_added_tokens_in_texts_are_encoded_as_the_tokenizer_does():
    import pyarrow as pa

    rng = random.Random(6)
    parts = ["<|endoftext|>", "a", " word", "\n", "  ", "<|", "endoftext|>", "é."]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(400)]
    flat, counts = packing.encode(PATH, pa.array(texts))
    assert [ids.tolist() for ids in np.split(flat, np.cumsum(counts)[:-1])] == ids_of(texts)
    assert 50256 in flat


def test_packing_fills_sequences(documents):
    sequences = collections.defaultdict(list)
    for r in packing.pack(documents, PATH).collect():
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = total = 0
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own[:-1]]))
        size = sum(n for _, n in own)
        assert size <= packing.CAPACITY
        total += size
        padding += 0 if size & (size - 1) == 0 else packing.CAPACITY - size
    assert padding < 0.02 * total


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(5)
    for _ in range(20):
        places = np.unique(np.concatenate([[0], np.cumsum(rng.integers(1, 9, 40))]))
        penalties = rng.integers(0, 6, len(places))
        best = [0.0] * len(places)
        for j in range(1, len(places)):
            best[j] = min(
                best[i] + 16 - (places[j] - places[i]) + penalties[j] for i in range(j) if places[j] - places[i] <= 16
            )
        chain = packing.cut(places, penalties, 16)
        cost = sum(16 - (places[j] - places[i]) + penalties[j] for i, j in zip(chain, chain[1:]))
        assert cost == best[-1]


def least_common(docs):
    """Component of every id by comparing all pairs."""
    sets = {}
    for doc, text in docs:
        if doc is None:
            continue
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[doc] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for i in names:
        for j in names:
            if i < j and sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return sets, {d: find(d) for d in sets}


@pytest.mark.parametrize("block", [neardup.BLOCK, 3])
def test_near_duplicates_find_every_link(documents, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    sets, roots = least_common([(c[0], c[1]) for c in corpus()])
    rows = neardup.near_duplicates(documents).collect()
    assert len(rows) == documents.count()
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), roots[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_pruning_table_follows_the_posterior():
    least = neardup.least_matches()
    assert len(least) == neardup.HASHES // neardup.BATCH and list(least) == sorted(least)
    assert all(m < 0.75 * n for m, n in zip(least, range(neardup.BATCH, neardup.HASHES + 1, neardup.BATCH)))


def test_signatures_look_at_few_bytes_at_once(monkeypatch):
    seen, shingle_sets = [], neardup.shingle_sets
    monkeypatch.setattr(neardup, "shingle_sets", lambda column: seen.append(column.nbytes) or shingle_sets(column))
    texts = [f"text {k} " + "of some common words " * 1000 for k in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(range(100)), pa.array(texts)], names=["doc_id", "text_hash", "text"])
    signed = pa.Table.from_batches(neardup._sign(iter([batch])))
    assert signed.column("doc_id").to_pylist() == list(range(100)) and max(seen) < 1 << 19
    del seen[:]
    pairs = pa.RecordBatch.from_arrays([batch[0], batch[0], batch[2], batch[2]], names=["a", "b", "one", "two"])
    assert sum(b.num_rows for b in neardup._confirm(iter([pairs]))) == 100 and max(seen) < 1 << 19


def covered(texts):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[k : k + 400] for d in data for k in range(len(d) - 399))
    for d in data:
        mark = np.zeros(len(d) + 1, int)
        for k in range(len(d) - 399):
            if seen[d[k : k + 400]] > 1:
                mark[k] += 1
                mark[k + 400] -= 1
        yield d, np.cumsum(mark)[: len(d)] > 0


@pytest.mark.parametrize("hot", [substrings.HOT_BYTES, 1000])
def test_repeated_strings_match_brute_force(spark, documents, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_BYTES", hot)
    wanted = collections.Counter()
    for (doc, *_), (data, gone) in zip(corpus(), covered([c[1] for c in corpus()])):
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        wanted[doc, len(data), int(gone.sum()), runs, kept] += 1
    rows = substrings.remove_repeats(documents).collect()
    found = collections.Counter((r.doc_id, r._n_bytes, r._n_removed, len(r._runs), bytes(r._kept)) for r in rows)
    assert found == wanted


def passages(texts, n):
    """The bytes of each text that windows of ``n`` words cover which start at two places."""
    found = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in texts]
    words = [[(t or "").encode()[a:b] for a, b in spans] for t, spans in zip(texts, found)]
    seen = collections.Counter(tuple(w[k : k + n]) for w in words for k in range(len(w) - n + 1))
    for t, w, spans in zip(texts, words, found):
        gone = np.zeros(len((t or "").encode()), bool)
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k : k + n])] > 1:
                gone[spans[k][0] : spans[k + n - 1][1]] = True
        yield gone


@pytest.mark.parametrize("words, hot", [(50, substrings.HOT_BYTES), (20, substrings.HOT_BYTES), (20, 300)])
def test_repeated_passages_match_brute_force(spark, documents, monkeypatch, words, hot):
    monkeypatch.setattr(substrings, "HOT_BYTES", hot)
    rows = corpus()
    texts = [c[1] for c in rows]
    spaced = [(1000 + k, re.sub(" ", "  \n" if k % 2 else "\t", t)) for k, t in enumerate(texts[86:90])]
    texts += [t for _, t in spaced]
    more = spark.createDataFrame([(k, t, None, None, 0, 0, None) for k, t in spaced], documents.schema)
    wanted = collections.Counter()
    ids = [c[0] for c in rows] + [k for k, _ in spaced]
    for doc, (data, gone), also in zip(ids, covered(texts), passages(texts, words)):
        gone = gone | also
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        wanted[doc, int(gone.sum()), runs, bytes(np.frombuffer(data, np.uint8)[~gone])] += 1
    found = substrings.remove_repeats(documents.unionAll(more), words=words).collect()
    assert collections.Counter((r.doc_id, r._n_removed, len(r._runs), bytes(r._kept)) for r in found) == wanted


def test_substring_stage_takes_out_short_passages(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join(f"{rng.randrange(10**4)}" for _ in range(n))
    passage, short = prose(51), prose(49)
    assert len(passage) < 400
    texts = [f"{prose(30)} {passage} é {prose(9)}", f"ü\n{passage.replace(' ', chr(10), 3)}", f"{short} a", f"{short} b", passage, passage]
    frame = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    rows = {r.doc_id: r for r in substrings.stage(spark, frame, "").collect()}
    wanted = [texts[0].replace(passage, ""), "ü\n", texts[2], texts[3], "", ""]
    assert [rows[k].text for k in range(6)] == wanted and [rows[k].n_chars for k in range(6)] == [len(t) for t in wanted]


def test_word_codes_tell_words_apart_in_any_slice(monkeypatch):
    texts = ["", "a bb", "  ", "bb\ta" + "c" * 60, "a bb " * 30]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])
    codes, at = substrings.word_codes(data, starts)
    assert (at // substrings.WORD_BYTES).tolist() == np.cumsum([0, *[len(t.split()) for t in texts]]).tolist()
    numbers = dict(zip("".join(f"{t} " for t in texts).split(), codes.view("<u4").tolist()))
    assert [numbers[w] for t in texts for w in t.split()] == codes.view("<u4").tolist() and len(set(numbers.values())) == 3
    monkeypatch.setattr(substrings, "SLICE", 7)
    assert substrings.word_codes(data, starts)[0].tolist() == codes.tolist()


def test_suffix_order_and_shared_prefixes():
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(1, 4, 300), 0)
    text[200:260] = text[20:80]
    order = substrings.suffix_order(text)
    suffixes = [tuple(text[k:]) for k in range(len(text))]
    assert order.tolist() == sorted(range(len(text)), key=lambda k: suffixes[k])
    for least in (1, 4, 28, 30, 50, 60):
        same = substrings.shared_prefixes(text, order, least)
        wanted = [False] + [suffixes[a][:least] == suffixes[b][:least] for a, b in zip(order, order[1:])]
        assert same.tolist() == wanted


def test_parts_are_compared_without_their_cores():
    rng, length = random.Random(5), substrings.LENGTH
    base = [rng.choice("abcdefgh") for _ in range(9000)]
    texts = [base]
    for step in (380, 417, 950):
        texts.append([("X" if k % step == step - 1 else c) for k, c in enumerate(base)])
    texts = ["".join(t).encode() for t in texts]
    starts = np.cumsum([0, *map(len, texts)])
    row, start, n, key, _, inner = substrings.stretches(np.frombuffer(b"".join(texts), np.uint8), starts, length)
    assert not inner.any()

    def batch(places):
        listed = [[dict(zip(("start", "n", "key", "hot", "lead"), p[1:])) for p in places if p[0] == t] for t in range(len(texts))]
        names = pa.array(range(len(texts)))
        kind = pa.struct([("start", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("hot", pa.bool_()), ("lead", pa.int64())])
        return pa.RecordBatch.from_arrays([names, names, pa.array(texts), pa.array(listed, pa.list_(kind))], names=["t1", "t2", "text", "places"])

    whole = [(*p, False, None) for p in zip(row.tolist(), start.tolist(), n.tolist(), key.tolist())]
    parts = pa.Table.from_batches(substrings._parts(length)([batch(whole)])).to_pylist()
    assert len({p["key"] for p in parts}) > substrings.MARKS

    def found(places):
        pieces = pa.Table.from_batches(substrings._cut(length)([batch(places)]))
        gone = set()
        for s in substrings._compare(pieces, length).to_pylist():
            gone.update((s["t1"], k) for k in range(s["start"], s["end"] - length + 1))
        return pieces, gone

    wanted = collections.Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    again = {(t, k) for t, x in enumerate(texts) for k in range(len(x) - length + 1) if wanted[x[k : k + length]] > 1}
    assert 0 < len(again) < sum(wanted.values())
    for hot in (False, True):
        pieces, gone = found([(p["t1"], p["start"], p["n"], p["key"], hot, p["lead"]) for p in parts])
        assert gone == again
        assert max(map(len, pieces["bytes"].to_pylist())) == (length + 31 if hot else 62)
    # Whole stretches and parts without cores can share a bucket.
    half = [(p["t1"], p["start"], p["n"], p["key"], False, p["lead"]) for p in parts]
    mixed = pa.concat_tables([found(half)[0], found(whole)[0]])
    both = {(s["t1"], k) for s in substrings._compare(mixed, length).to_pylist() for k in range(s["start"], s["end"] - length + 1)}
    assert both == again


def test_rule_counts_match_brute_force(spark, documents):
    rows, name = rules.quality_rules(documents)
    assert rows.columns[:-1] == documents.columns and rows.count() == documents.count()
    texts = {(c[0], c[1]) for c in corpus()}
    for r in rows.collect():
        assert (r.doc_id, r.text) in texts
        text, own = r.text or "", r[name]
        words = WORD.findall(text)
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        again = set()
        for k in range(len(words) - 2):
            if windows[tuple(words[k : k + 3])] > 1:
                again |= {k, k + 1, k + 2}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        assert (own.n_words, own.word_chars, own.n_symbols) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text)
        )
        assert (own.n_dup_lines, own.n_repeat_words, own.base_failed) == (
            len(lines) - len(set(lines)), len(again), failed
        )
        assert not (own.base_failed and own.kept)


def test_rules_reject_outliers_and_keep_clean_documents(spark):
    clean = [(k, " ".join(f"word{(k * 31 + j * j) % 977}" for j in range(120)), "en", f"s{k % 3}") for k in range(400)]
    noisy = [(1000 + k, " ".join(f"word{(k + j * j) % 977}###" for j in range(120)), "en", f"s{k % 3}") for k in range(40)]
    frame = spark.createDataFrame(clean + noisy, "doc_id long, text string, lang string, source string")
    rows, name = rules.quality_rules(frame)
    kept = {r.doc_id for r in rows.filter(F.col(name)["kept"]).collect()}
    assert kept == {k for k, *_ in clean}


def test_shards_hold_near_equal_bytes_without_gaps(documents):
    records = sharding.slotted(documents)
    sizes = sharding.slot_sizes(records)
    rows = sharding.shard(records, sizes, sharding.slot_map(sizes)).collect()
    assert len(rows) == documents.count()
    load, places = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    texts = {c[0]: c[1] or "" for c in corpus()}
    for r in rows:
        data = (texts[r.doc_id]).encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))


def test_a_text_of_a_third_of_all_rows_is_cut_and_edits_move_little(spark):
    rows = [(k, "hot text of some length" if k % 3 == 0 else f"text {k} " + "x" * (k % 50)) for k in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    records = sharding.slotted(frame)
    sizes = sharding.slot_sizes(records)
    first = sharding.slot_map(sizes)
    load = [r["sum(size)"] for r in sharding.shard(records, sizes, first).groupBy("shard").sum("size").collect()]
    assert len(load) == 8 and max(load) < 1.02 * min(load)
    grown = sharding.slot_map(sizes, shards=9, old=first, version=2)
    moved = grown.join(first.withColumnRenamed("shard", "was"), ["virtual_slot", "unit"]).filter("shard <> was").count()
    assert {r.version for r in grown.select("version").distinct().collect()} == {2}
    assert 0 < moved < 0.3 * first.count()


def test_only_a_heavy_text_is_parted(spark):
    slot = F.pmod(F.xxhash64("text"), F.lit(sharding.SLOTS))
    many = spark.range(60_000).select(F.concat(F.lit("t"), F.col("id")).alias("text")).withColumn("slot", slot)
    hot = many.limit(1).collect()[0]
    # Other texts of the heavy text's slot, five copies of each.
    near = many.where((F.col("slot") == hot.slot) & (F.col("text") != hot.text)).select("text").collect()
    texts = [hot.text] * 4000 + [r.text for r in near for _ in range(5)] + [f"other {k}" for k in range(3000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    records = sharding.slotted(frame)
    sizes = sharding.slot_sizes(records)
    placed = sharding.shard(records, sizes, sharding.slot_map(sizes)).join(frame, "doc_id")
    parted = placed.groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").collect()
    assert near and [r.text for r in parted] == [hot.text]
    places = placed.groupBy("shard").agg(F.max("slot").alias("top"), F.countDistinct("slot").alias("n"), F.count("*").alias("m"))
    assert all(r.top + 1 == r.n == r.m for r in places.collect())


def level(sizes):
    """Targets by the literal rule: share by weight, stop at three times, share the excess anew."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, fixed = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in fixed)
        total = sum(weight[s] for s in order if s not in fixed)
        target = {s: 3 * sizes[s] if s in fixed else rest * weight[s] / total for s in order}
        over = {s for s in order if s not in fixed and target[s] > 3 * sizes[s]}
        if not over:
            return target
        fixed |= over


def test_mix_reaches_its_targets(documents):
    rows = mixing.mix(documents).collect()
    assert len(rows) == documents.count()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
    target = level(sizes)
    taken = collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-12)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in target.items():
        assert taken[s] == math.floor(t + 1e-9)
    again = mixing.mix(documents.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_mix_stage_holds_what_is_taken(spark, documents):
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    out = mixing.stage(spark, documents, "")
    assert out.columns == documents.columns
    wanted = mixing.mix(documents).agg(F.sum("taken")).first()[0]
    assert out.agg(F.sum(words)).first()[0] == wanted


def kept_by_rules(spark, rows):
    """Kept rows of (lang, source, symbols per word, repeated lines), other measures being clean."""
    schema = "id long, lang string, source string, s double, l double"
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], schema)
    fields = [("n_words", F.lit(100)), ("base_failed", F.lit(False)), ("symbols_per_word", F.col("s"))]
    fields += [("repeated_lines", F.col("l")), ("repeated_words", F.lit(0.0)), ("word_length", F.lit(5.0))]
    made = frame.withColumn("rules", F.struct(*[c.alias(n) for n, c in fields]))
    made.write.mode("overwrite").parquet(path := scratch_path(spark, "rules-test"))
    return {r.id for r in rules.judged(spark.read.parquet(path), "rules").filter("rules.kept").collect()}


@pytest.mark.parametrize("share", [3, 4, 6])
def test_junk_does_not_raise_the_limit_of_its_source(spark, share):
    clean = [("en", f"s{k % 4}", 0.001 * (k % 20), 0.0) for k in range(2400)]
    dirty = [("en", "bad", 2.5, 0.9) if k % 10 < share else ("en", "bad", 0.0, 0.0) for k in range(600)]
    rows = clean + dirty
    assert kept_by_rules(spark, rows) == {k for k, r in enumerate(rows) if r[2] < 1}


def test_junk_of_a_whole_language_and_gaps_below_the_reach(spark):
    rows = [("xx", "one", 2.5 if k % 10 < 4 else 0.002 * (k % 7), 0.0) for k in range(500)]
    rows += [("en", "two", 0.18 if k % 10 < 3 else 0.0, 0.0) for k in range(500)]
    rows += [("en", "three", 0.01 * (k % 10), 0.01 * (k % 5)) for k in range(500)]
    assert kept_by_rules(spark, rows) == {k for k, r in enumerate(rows) if r[2] < 0.15}


def test_empty_tables_give_no_rows(spark, nothing):
    assert packing.pack(nothing, PATH).count() == 0
    assert mixing.mix(nothing).count() == 0
    assert substrings.remove_repeats(nothing).count() == 0
    assert neardup.near_duplicates(nothing).count() == 0
    assert rules.quality_rules(nothing)[0].count() == 0
    records = sharding.slotted(nothing)
    sizes = sharding.slot_sizes(records)
    assert sharding.shard(records, sizes, sharding.slot_map(sizes)).count() == 0


def test_kept_hash_of_nothing_removed(spark):
    frame = spark.createDataFrame([(1, "short"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in substrings.remove_repeats(frame).collect()}
    assert hashlib.sha256(rows[1]._kept).hexdigest() == hashlib.sha256(b"short").hexdigest()
    assert bytes(rows[2]._kept) == b"" and rows[2]._n_bytes == 0


def test_substring_stage_leaves_text(spark):
    shared = "ü" * 260
    frame = spark.createDataFrame(
        [(1, "aé" + shared + "xy", 3), (2, "bé" + shared + "z", 4), (3, None, 5)], "doc_id long, text string, n_chars long"
    )
    rows = {r.doc_id: r for r in substrings.stage(spark, frame, "").collect()}
    assert (rows[1].text, rows[1].n_chars) == ("axy", 3) and rows[2].text == "bz" and rows[3].text == ""


CLASHES = ["gone_id", "_t1", "_n_bytes", "_mix_id", "_taken", "_own_size", "mix_row", "near_id", "near_key", "rules_x", "Key"]


@pytest.mark.parametrize("stage", [rules.stage, neardup.stage, substrings.stage, mixing.stage])
def test_stages_keep_columns_whatever_their_names(spark, documents, stage):
    wide = documents.select("*", *[F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in CLASHES])
    out = stage(spark, wide, "")
    assert out.columns == wide.columns
    rows = out.collect()
    assert rows and all(r[c] == (None if r.doc_id is None else f"{c} {r.doc_id}") for r in rows for c in CLASHES)
    plain = stage(spark, documents, "")
    assert sorted(map(repr, out.select(*documents.columns).collect())) == sorted(map(repr, plain.collect()))


def test_scratch_tables_go(spark, documents):
    import pathlib

    from reelstat.session import shared_dir

    folder = pathlib.Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    assert neardup.near_duplicates(documents).count() == documents.count()
    assert substrings.remove_repeats(documents).count() == documents.count()
    kinds = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert kinds == {"near-duplicates", "repeat-marks"}


def test_links_of_ids_with_several_texts(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3)]
    rows = [(5, texts[0]), (5, texts[1]), (7, texts[0] + " more"), (9, "x " + texts[1]), (11, texts[2]), (11, texts[2])]
    rows += [(None, texts[2]), (None, texts[2]), (None, "alone")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.component_id) for r in neardup.near_duplicates(frame).collect()), key=repr)
    assert found == sorted([(5, 5), (5, 5), (7, 5), (9, 5), (11, 11), (11, 11)] + [(None, None)] * 3, key=repr)
    kept = neardup.stage(spark, frame, "").collect()
    assert sorted([r.doc_id for r in kept], key=repr) == [11, 5, None, None]
    assert sorted(r.text for r in kept if r.doc_id is None) == sorted([texts[2], "alone"])


def test_schema_has_clashing_columns(documents):
    assert documents.columns == [c.split()[0].strip("`") for c in SCHEMA.split(", ")]
