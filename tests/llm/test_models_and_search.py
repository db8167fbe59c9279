"""Pages, neighbours, classifiers and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelstat.llm import common, neighbours, pages, quality, toxicity
from tests.llm.conftest import SCHEMA, corpus, prose


@pytest.mark.parametrize(
    "html, wanted",
    [
        (None, ([], False)),
        ("", ([], False)),
        ("a &lt; b &amp c&nbsp;d", (["a < b & c d"], False)),
        ("<nav>Menu</nav><article><h1>T</h1><p>A <b>b</b>\n c<p>D<br>e</article><footer>f</footer>", (["T", "A b c", "D e"], True)),
        ("<article>x<script>var t='</p><p>no'</script><style>p{}</style>y<!-- <p>no</p> -->z</article>", (["xyz"], True)),
        ("<main><div class='ad-box'>buy</div><form>q<input></form><p>text</p><div id=comments>c</div></main>", (["text"], True)),
        ("<header><h1>Site</h1></header><article><header><h1>Head</h1>by me</header>x</article>", (["Head", "x"], True)),
        ("<article><p>cut off <a href='x", (["cut off"], True)),
        ("<article><p>1 < 2 and <x</p></article", (["1 < 2 and"], True)),
        ("<div role='navigation'>m</div><div class=cookie-notice>c</div><aside>s</aside><div>body", (["body"], False)),
        ("<article>a</article><section class='comments'><article>no</article></section><article>b</article>", (["a", "b"], True)),
    ],
)
def test_blocks(html, wanted):
    assert pages.blocks(html) == wanted


def test_shared_runs_leave_unmarked_pages(spark, monkeypatch):
    rng = random.Random(3)
    boiler = "Sign up for our weekly letter and read all stories first every day"
    bodies = [prose(rng, 40, 9000) for _ in range(40)]
    html = [f"<div>{boiler}</div><div>{b}</div><div>All rights reserved by the owners of this site and more</div>" for b in bodies]
    rows = [(k, f"http://h{k % 2}.example/{k}", h, "c") for k, h in enumerate(html)]
    rows += [(100, None, html[0], "c"), (101, "http://alone.example/", html[1], "c"), (102, "x", None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {r.page_id: r.text for r in pages.extract(frame).collect()}
    assert all(found[k] == b for k, b in enumerate(bodies))
    assert boiler in found[101] and found[102] == ""
    assert pages.extract(frame.limit(0)).count() == 0
    monkeypatch.setattr(pages, "GROUP", 12)
    assert {r.page_id: r.text for r in pages.extract(frame).collect()} == found


def test_what_a_host_puts_in_its_articles_goes_and_shared_passages_stay(spark):
    note, passage = "Read our newsletter every week now", "A passage that two or three articles of the host share."
    html = lambda *blocks: "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    own = lambda k: f"This is what article {k} alone tells, in more characters than the note of its host has."
    rows, wanted = [], {}
    for k in range(8):
        shared = [passage] if k < 4 else []
        rows.append((k, "http://a.org/x", html(own(k), *shared, note)))
        wanted[k] = "\n\n".join([own(k), *shared])
        # Near copies of one article share all but a little, and the note on few articles of a host stays.
        rows.append((100 + k, "http://b.org/x", html(own(0), passage, f"Edition {k}")))
        wanted[100 + k] = f"{own(0)}\n\n{passage}\n\nEdition {k}"
        rows.append((200 + k, "http://c.org/x", html(own(k), *[note] * (k < 3))))
        wanted[200 + k] = "\n\n".join([own(k), *[note] * (k < 3)])
    # Equal pages count once: these are two articles of their host.
    rows += [(300 + k, "http://d.org/x", html(own(k % 2), note)) for k in range(6)]
    wanted |= {300 + k: f"{own(k % 2)}\n\n{note}" for k in range(6)}
    rows += [(400 + k, None, html(own(k), note)) for k in range(3)] + [(500, None, "<article></article>")]
    wanted |= {400 + k: own(k) for k in range(3)} | {500: ""}
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == wanted


def test_rare_boilerplate_is_counted_over_all_groups(spark, monkeypatch):
    monkeypatch.setattr(pages, "GROUP", 4)
    rng = random.Random(4)
    notice = "Our autumn campaign is open for all readers of this site until the end of may"
    bodies = [prose(rng, 40, 9000) for _ in range(120)]
    html = [f"<div>{b}</div>" + f"<div>{notice}</div>" * (k % 30 == 0) for k, b in enumerate(bodies)]
    rows = [(k, f"http://host.example/{k}", h) for k, h in enumerate(html)]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == dict(enumerate(bodies))


@pytest.mark.parametrize(
    "html, wanted",
    [
        ("<div class='layout has-sidebar'><article><p>text</p></article></div>", (["text"], True)),
        ("<div class='post no-comments'><article>text</article></div>", (["text"], True)),
        ("<div class='search-page'><main>text</main></div>", (["text"], True)),
        ("<div class='overlay'><article><header><h1>T</h1>x</header>text</article></div>", (["T", "text"], True)),
        ("<article><h2 id='social-policy'>A</h2><h2 id='related-work'>B</h2><h2 id=related>C</h2>d</article>", (["A", "B", "C", "d"], True)),
        ("<div class='related-posts'>x</div><div class='related'><article>other</article></div><p>text", (["text"], False)),
        ("<article><div class='newsletter-signup'>n</div><div class='ad-box-2'>buy</div>text</article>", (["text"], True)),
    ],
)
def test_names_in_layout_classes_and_slugs_lose_no_article(html, wanted):
    assert pages.blocks(html) == wanted


@pytest.mark.parametrize(
    "html, wanted",
    [
        ("<article><button>Go<p>text</p><p>more</p></article>", (["text", "more"], True)),
        ("<article>a<select><option>x</select>b<button>c</button>d</article>", (["abd"], True)),
        ("<article><button>one<p>kept</p><button>two</button></article>", (["kept"], True)),
        ("<article><svg><text>no</text></svg>a<noscript>turn on</noscript><math><mi>x</mi></math></article>", (["ax"], True)),
        ("<article><p>" + "long text " * 9 + "</p></article><article><h2>Teaser</h2></article>", (["long text " * 8 + "long text"], True)),
        ("<main><p>intro</p><article>" + "word " * 20 + "</article><article>teaser</article></main>", (["intro", "word " * 19 + "word"], True)),
        ("<article><ul class='key-notices'><li>one</li></ul><div class='cookie-notice'>c</div><p>x</p></article>", (["one", "x"], True)),
    ],
)
def test_unclosed_elements_teasers_and_vague_names(html, wanted):
    assert pages.blocks(html) == wanted


def boilerplate(streams, enough=pages.PAGES):
    """For each page's blocks whether runs of tokens that enough distinct pages hold cover them whole, run by run."""
    tokens = [[t for block in s for t in (*block.split(), "\n")] for s in streams]
    enough = min(enough, max(2, len(set(map(tuple, tokens)))))
    holders = {}
    for own in tokens:
        for k in range(len(own) - pages.RUN + 1):
            holders.setdefault(tuple(own[k : k + pages.RUN]), set()).add(tuple(own))
    out = []
    for stream, own in zip(streams, tokens):
        covered = [False] * len(own)
        for k in range(len(own) - pages.RUN + 1):
            if len(holders[tuple(own[k : k + pages.RUN])]) >= enough:
                covered[k : k + pages.RUN] = [True] * pages.RUN
        at, flags = 0, []
        for block in stream:
            n = len(block.split())
            flags.append(all(covered[at : at + n]))
            at += n + 1
        out.append(flags)
    return out


def test_copies_of_a_page_are_not_boilerplate():
    stream = ["one two three four five six seven eight nine ten", "and so on for some more words here"]
    assert boilerplate([stream] * 5) == [[False, False]] * 5


@pytest.mark.parametrize("group", [pages.GROUP, 5])
def test_extraction_matches_brute_force_runs(spark, monkeypatch, group):
    monkeypatch.setattr(pages, "GROUP", group)
    rng = random.Random(14)
    shared = [" ".join(f"s{k}x{j}" for j in range(rng.randrange(3, 15))) for k in range(12)]
    html = []
    for k in range(60):
        own = [prose(rng, rng.randrange(1, 30), 5000) for _ in range(3)]
        some = own + rng.sample(shared, 3) + ([own[0] + " " + shared[0]] if k % 5 == 0 else [])
        rng.shuffle(some)
        html.append((f"http://h{k % 3}.example/{k}", "".join(f"<div>{b}</div>" for b in some)))
    html += html[:4]
    rows = [(k, url, h) for k, (url, h) in enumerate(html)]
    found = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for host in range(3):
        own = [(k, pages.blocks(h)[0]) for k, url, h in rows if url.startswith(f"http://h{host}.")]
        for (k, stream), flags in zip(own, boilerplate([s for _, s in own])):
            assert found[k] == "\n\n".join(b for b, g in zip(stream, flags) if not g)


def brute(rows, nearest):
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = set()
    for q, x in {i: v for i, v in usable if i % 20 == 0}.items():
        scored = set()
        for i, y in usable:
            if i != q and len(x) == len(y):
                total = 0.0
                for a, b in zip(x, y):
                    total += a * b
                scored.add((-total, i))
        out |= {(q, k, i, -s) for k, (s, i) in enumerate(sorted(scored)[:nearest], 1)}
    return out


@pytest.mark.parametrize("block", [neighbours.CANDIDATE_BLOCK, 70])
def test_neighbours_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 9)
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((400, 16)).astype(np.float32).tolist()
    rows = [(k, v) for k, v in enumerate(vectors)] + [(1000 + k, vectors[7]) for k in range(60)]
    rows += [(2000, None), (2020, []), (2040, [0.0] * 16), (2060, [1.0, None] * 8), (2080, [float("nan")] * 16)]
    rows += [(2100, [1.0, 2.0]), (2101, [3.0, 1.0]), (None, vectors[0]), (5, vectors[5]), (2120, [1e30] * 16)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    index = neighbours.encode(frame)
    found = neighbours.nearest_neighbours(index, index.filter("vec_id % 20 = 0"))
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()}
    wanted = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 20)
    assert len(got & wanted) >= 0.98 * len(wanted) and len(got) == len(wanted)
    assert neighbours.nearest_neighbours(index.limit(0), index.limit(0)).count() == 0


def held_out(rows, folds, which):
    return [zlib.crc32(str(r.doc_id).encode()) % folds == which for r in rows]


def test_quality_ranks_held_out_documents(spark):
    rng = random.Random(5)
    texts = [prose(rng, 150) if k % 2 else " ".join(w + "###" for w in prose(rng, 150).split()) for k in range(600)]
    frame = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(k, k % 2) for k in range(600)], "doc_id long, quality int")
    scored = quality.score(frame, quality.fit(frame, labels)).collect()
    out = held_out(scored, 4, 2)
    assert sum(out) > 100
    assert np.mean([(r.score >= 0.5) == r.doc_id % 2 for r, o in zip(scored, out) if o]) > 0.95


def test_quality_scores_every_odd_text(spark, documents, nothing):
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(70)], "doc_id long, quality int, text string")
    model = quality.fit(documents, labels)
    scored = quality.score(documents, model).collect()
    assert len(scored) == documents.count() and all(0 <= r.score <= 1 for r in scored)
    assert quality.score(nothing, model).count() == 0
    assert quality.fit(documents, labels.limit(0)) is None and quality.fit(nothing, labels) is None
    assert {r.score for r in quality.score(documents, None).collect()} == {0.5}


def test_attention_gradient_matches_differences():
    rng = np.random.default_rng(0)
    model = quality.Model()
    model.weights = [w.astype(float) for w in model.weights]
    x, bag, y = rng.standard_normal((9, quality.FEATURES)), np.array([0, 0, 0, 1, 1, 2, 2, 2, 2]), np.array([1.0, 0, 1])

    def loss():
        p = model.forward(x, bag, 3)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = model.gradient(x, bag, y)
    for k, g in enumerate(grads):
        at = tuple(rng.integers(0, n) for n in g.shape)
        start = model.weights[k][at]
        model.weights[k][at] = start + 1e-2
        up = loss()
        model.weights[k][at] = start - 1e-2
        down = loss()
        model.weights[k][at] = start
        assert abs((up - down) / 2e-2 - (g[at] - 1e-4 * start)) < 2e-3


def test_toxicity_finds_held_out_toxic_documents(spark):
    rng = random.Random(6)
    bad = ["vile", "rotten", "filth", "dung"]
    texts = []
    for k in range(900):
        words = prose(rng, 120, 3000).split()
        if k % 6 == 0:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append(" ".join(words))
    frame = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(k, int(k % 6 == 0)) for k in range(900)], "doc_id long, toxic int")
    scored = toxicity.score(frame, *toxicity.fit(frame, labels)).collect()
    out = held_out(scored, 5, 0)
    right = [(r.score >= 0.5) == (r.doc_id % 6 == 0) for r, o in zip(scored, out) if o]
    assert len(right) > 100 and np.mean(right) > 0.95


def test_toxicity_scores_every_odd_text(spark, documents, nothing):
    labels = spark.createDataFrame([(k, int(k % 5 == 0), None) for k in range(70)], "doc_id long, toxic int, text string")
    model = toxicity.fit(documents, labels)
    scored = toxicity.score(documents, *model).collect()
    assert len(scored) == documents.count() and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.score(nothing, *model).count() == 0
    assert {r.score for r in toxicity.score(documents, *toxicity.fit(documents, labels.limit(0))).collect()} == {0.5}


def by_hand(texts, toxic):
    """Different words before each word per class and over all texts."""
    found = {0: {}, 1: {}, None: {}}
    for text, k in zip(texts, toxic):
        before = ""
        for w in text.split():
            for kind in {k, None}:
                found[kind].setdefault(w, set()).add(before)
            before = w
    return {k: {w: len(s) for w, s in words.items()} for k, words in found.items()}


def test_toxicity_counts_grow_with_the_vocabulary(spark):
    many = [" ".join(f"w{k}x{j} common" for j in range(40)) for k in range(30)] + ["copied passage here"] * 50
    toxic = [int(k % 3 == 0) for k in range(80)]
    frame = spark.createDataFrame([(k, t, 1) for k, t in enumerate(many)], "doc_id long, text string, toxic int")
    hashed = lambda w: int(toxicity._tokens(pa.array([w]))[0].view(np.int64)[0])
    wanted = by_hand(many, toxic)
    pairs = frame.select("text").mapInArrow(toxicity._all_pairs(), toxicity.PAIR).distinct()
    got = {r.word: r["count"] for r in pairs.groupBy("word").count().collect()}
    assert got == {hashed(w): n for w, n in wanted[None].items()}
    some = toxicity.KeySet(spark.createDataFrame([(hashed("common"),), (hashed("here"),)], "word long"))
    pairs = frame.select("text").mapInArrow(toxicity._all_pairs(some), toxicity.PAIR).distinct()
    few = {r.word: r["count"] for r in pairs.groupBy("word").count().collect()}
    assert few.items() <= got.items() and {hashed("common"), hashed("here")} <= few.keys() and len(few) < 100
    parts = frame.select("text", F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0).alias("toxic"))
    classes = toxicity.class_counts(parts.mapInArrow(toxicity._class_pairs, toxicity.PAIR))
    got = {r.word: (r.t, r.o) for r in classes.words.collect()}
    assert got == {hashed(w): (wanted[1].get(w, 0), wanted[0].get(w, 0)) for w in wanted[None]}
    assert classes.total == {k: sum(wanted[k].values()) for k in (0, 1)}
    assert classes.rest == {k: sum(min(n, 2) for n in wanted[k].values()) for k in (0, 1)}


def scores_by_hand(texts, labels):
    """Scores of all texts, learned from the labelled ones outside the held-out fold, word by word."""
    words = [re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t)) for t in texts]
    taught = {k: y for k, y in labels.items() if zlib.crc32(str(k).encode()) % toxicity.FOLDS}
    own = by_hand([" ".join(words[k]) for k in taught], list(taught.values()))
    shared = by_hand([" ".join(w) for w in words], [0] * len(words))[None]
    everything = sum(shared.values())
    total = {k: sum(own[k].values()) for k in (0, 1)}
    rest = {k: sum(min(n, toxicity.DISCOUNT) for n in own[k].values()) for k in (0, 1)}

    def weight(w):
        n = [own[k].get(w, 0) for k in (0, 1)]
        if max(n) <= toxicity.DISCOUNT:
            return 0.0
        p = [(max(n[k] - toxicity.DISCOUNT, 0) + rest[k] * shared[w] / everything) / total[k] for k in (0, 1)]
        ratio = math.log(p[1] / p[0])
        return math.copysign(max(abs(ratio) - toxicity.MARGIN, 0), ratio)

    value = [sum(map(weight, w)) / (len(w) + toxicity.SHORT) for w in words]
    x, y = np.array([value[k] for k in taught]), np.array([float(v) for v in taught.values()])
    offset, slope = toxicity._curve((x - x.mean()) / x.std(), y)
    return [1 / (1 + math.exp(-min(30, max(-30, offset + slope * (v - x.mean()) / x.std())))) for v in value]


def test_toxicity_scores_match_brute_force(spark):
    rng = random.Random(12)
    texts = [prose(rng, rng.randrange(5, 120), 150) for _ in range(300)] + ["", "!?"]
    texts = [f"{t} Foul x{k % 7} foul {t[:6]} MUCK" if k % 5 == 0 else t for k, t in enumerate(texts)]
    labels = {k: int(k % 5 == 0) for k in range(0, 300, 2)}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.fit(frame, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    wanted = scores_by_hand(texts, labels)
    for r in toxicity.score(frame, *model).collect():
        # The number of all pairs is estimated.
        assert math.isclose(r.score, wanted[r.doc_id], abs_tol=0.02)


def test_toxicity_by_join_and_held_words_agree(spark, documents, monkeypatch):
    table = [(int(w), float(k % 5 - 2)) for k, w in enumerate(set(toxicity._tokens(pa.array([c[1] for c in corpus()]))[0].view(np.int64)))]
    ratios = spark.createDataFrame(table, "word long, ratio double")
    found = []
    for held in (1 << 20, 0):
        monkeypatch.setattr(toxicity, "HELD", held)
        evidence = toxicity.Evidence(ratios)
        assert (evidence.words is None) == (held == 0)
        rows = evidence.compare(documents.select("doc_id", "text")).collect()
        assert len(rows) == documents.count()
        found.append(sorted((r.doc_id is None, r.doc_id or 0, round(r.value, 9)) for r in rows))
    assert found[0] == found[1] and any(v[2] for v in found[0])


def test_toxicity_learns_a_rare_class_and_its_share(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 40)
    rng = random.Random(8)
    texts = [prose(rng, 60, 500) for _ in range(1200)]
    bad = {k for k in range(1200) if k % 150 == 7}
    texts = [f"{t} filth {t[:9]} filth so filth {k} filth" if k in bad else t for k, t in enumerate(texts)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # Labels of ids that no document has must not fill the sample.
    labels = [(k, int(k in bad)) for k in range(1200)] + [(k, 0) for k in range(5000, 9000)]
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r.doc_id for r in toxicity.score(frame, *model).collect() if r.score >= 0.5}
    assert found == bad


def test_toxicity_hears_pairs_of_ordinary_words(spark, monkeypatch):
    rng = random.Random(9)
    texts = []
    for k in range(900):
        words = prose(rng, 80, 3000).split()
        for _ in range(4):
            words[rng.randrange(len(words))] = "cold fish" if k % 6 == 0 else "fish cold"
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 6 == 0)) for k in range(900)], "doc_id long, toxic int")
    scored = []
    for most in (1 << 20, 0):
        monkeypatch.setattr(toxicity, "HELD", most)
        scored.append(sorted((r.doc_id, r.score) for r in toxicity.score(frame, *toxicity.fit(frame, labels)).collect()))
    assert all(math.isclose(a, b, abs_tol=1e-9) for (_, a), (_, b) in zip(*scored))
    right = [(p >= 0.5) == (k % 6 == 0) for k, p in scored[0] if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(right) > 100 and np.mean(right) > 0.95


def test_pair_counts_match_brute_force(spark):
    texts = ["a b a b", "a b c", "b c", "a b", "a c", "", "c a b"] * 4
    rows = [(t, int(k % 7 < 3)) for k, t in enumerate(texts)]
    wanted, after = {}, {}
    for text, kind in rows:
        words = text.split()
        for v, w in set(zip([None, *words], words)):
            for table, key in ((wanted, (w, v)), (after, v)):
                table.setdefault(key, [0, 0])[kind] += 1
    def named(pair):
        words, before, _, _ = toxicity._tokens(pa.array([" ".join(x for x in pair[::-1] if x)]))
        return int(words.view(np.int64)[-1]), int(toxicity._low(before)[-1])
    frame = spark.createDataFrame(rows, "text string, toxic int")
    found = toxicity._by_class(frame.mapInArrow(toxicity._holders(), toxicity.HOLDERS), "word", "before").collect()
    assert {(r.word, r.before): [r.o, r.t] for r in found} == {named(p): n for p, n in wanted.items()}
    lows = {named(p)[1]: n for p in wanted for n in [after[p[1]]]}
    only = toxicity.KeySet(spark.createDataFrame([(v,) for v in lows], "key long"))
    found = toxicity._by_class(frame.mapInArrow(toxicity._holders(only), toxicity.HOLDERS), "before").collect()
    assert {r.before: [r.o, r.t] for r in found} == lows


def test_toxicity_counts_the_pairs_of_repeated_and_odd_rows_once(spark, monkeypatch):
    texts = {k: f"w{k % 7} x{k % 5} w{k % 3} x{k % 2}" for k in range(60)}
    rows = [*texts.items(), (None, "lost words"), *[(3, "again w3 x3"), (3, None), (6, ""), (200, "no label here")]]
    labels = [(k, int(k % 3 == 0)) for k in range(60)] + [(3, 0), (6, None), (9, 2), (None, 1), (999, 1)]
    plans, counted = {}, []
    keep, count = toxicity.stored, toxicity.class_counts

    def stored(frame, name, **more):
        plans[name] = frame._jdf.queryExecution().optimizedPlan().toString()
        return keep(frame, name, **more)

    def class_counts(*given, **more):
        classes = count(*given, **more)
        counted.extend((r.word, r.t, r.o) for r in classes.words.collect())
        return classes

    monkeypatch.setattr(toxicity, "PAIR_DISCOUNT", 1.0)
    monkeypatch.setattr(toxicity, "stored", stored)
    monkeypatch.setattr(toxicity, "class_counts", class_counts)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    # Of several labels of an id the least counts; repeated rows of an id teach each, rows without an id nothing.
    least = {}
    for k, toxic in labels:
        if k is not None and toxic in (0, 1) and zlib.crc32(str(k).encode()) % toxicity.FOLDS:
            least[k] = min(toxic, least.get(k, 1))
    taught = [(t or "", least[k]) for k, t in rows if k in least]
    wanted = by_hand(*zip(*taught))
    hashed = lambda w: int(toxicity._tokens(pa.array([w]))[0].view(np.int64)[0])
    assert sorted(counted) == sorted((hashed(w), wanted[1].get(w, 0), wanted[0].get(w, 0)) for w in {*wanted[0], *wanted[1]})
    assert len(toxicity.score(frame, *model).collect()) == len(rows)
    assert [name for name, plan in plans.items() if "MapInArrow through" in plan] == ["toxic-taught"]
    # Counted once for the words of the classes and for their pairs; the weights of words before are counted apart.
    assert [name for name, plan in plans.items() if "MapInArrow holders" in plan] == ["toxic-pairs", "toxic-second"]
    assert "MapInArrow" not in plans["toxic-classes"]


def test_toxicity_counts_the_pairs_of_a_class_once(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PAIR_DISCOUNT", 2.0)
    texts = ["a b a b", "a b c", "b c", "a b", "a c", "", None, "c a b"] * 4 + ["d a", "c d b"]
    rows = [(t, int(k % 7 < 3)) for k, t in enumerate(texts)]
    learned = {y: sum(kind == y for _, kind in rows) for y in (0, 1)}
    hashed = lambda w: int(toxicity._tokens(pa.array([w]))[0].view(np.int64)[0])
    low = lambda v: int(toxicity._low(np.array([hashed(v) if v else 0]).view(np.uint64))[0])
    holders = {}
    for text, kind in rows:
        words = (text or "").split()
        for v, w in set(zip([None, *words], words)):
            holders.setdefault((w, v), [0, 0])[kind] += 1
    most = [2.0 * learned[y] / min(learned.values()) for y in (0, 1)]
    wanted = {}
    for (w, v), (o, t) in holders.items():
        own = o > most[0] or t > most[1]
        row = wanted.setdefault((hashed(w), low(v) if own else None), [0, 0])
        row[0], row[1] = (t, o) if own else (row[0] + (t > 0), row[1] + (o > 0))
    frame = spark.createDataFrame(rows, "text string, toxic int")
    counted = toxicity.held_pairs(frame, learned)
    assert {(r.word, r.before): [r.t, r.o] for r in counted.collect()} == wanted
    assert {v is None for _, v in wanted} == {True, False}
    classes, apart = (toxicity.class_counts(p) for p in (counted, frame.mapInArrow(toxicity._class_pairs, toxicity.PAIR)))
    assert sorted(classes.words.collect()) == sorted(apart.words.collect())
    assert (classes.total, classes.rest) == (apart.total, apart.rest)


def test_tasks_read_one_stored_file_each(spark, tmp_path):
    spark.range(0, 1000, 1, 40).write.parquet(str(tmp_path / "t"))
    read = lambda: spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions()
    before, cost = read(), spark.conf.get("spark.sql.files.openCostInBytes")
    with common.file_by_file(spark):
        assert read() == 40
    assert read() == before < 40 and spark.conf.get("spark.sql.files.openCostInBytes") == cost


def test_toxicity_weighs_ordinary_words_too(spark):
    shared = spark.createDataFrame([(1, 100), (2, 100), (3, 800), (4, 10)], "word long, n long")
    counted = spark.createDataFrame([(1, 60, 0), (2, 0, 60), (3, 400, 400), (4, 2, 0)], "word long, t long, o long")
    classes = toxicity.Classes(counted, {0: 460.0, 1: 460.0}, {0: 4.0, 1: 4.0})
    words = toxicity.telling_words(classes, 1000.0)
    assert {r.word for r in words.collect()} == {1, 2}
    ratios = toxicity.log_ratios(shared, classes, words, 1000.0)
    ratio = {r.word: r.ratio for r in ratios.collect()}
    weights = {r.word: r.weight for r in toxicity.Evidence(ratios).table.collect()}
    assert ratio[1] > toxicity.MARGIN and ratio[2] == -ratio[1]
    assert weights == {1: ratio[1] - toxicity.MARGIN, 2: toxicity.MARGIN - ratio[1]}


def test_tokens_and_the_words_before_them():
    words, before, rows, n = toxicity._tokens(pa.array(["A b, a", None, "b-a b"]))
    assert n == 3 and rows.tolist() == [0, 0, 0, 2, 2, 2]
    assert words[0] == words[2] == words[4] and words[1] == words[3] == words[5] and before[0] == before[3] == 0


def test_pipeline_runs_on_odd_documents(spark, documents, nothing, tmp_path):
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    docs, counts = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).persist()
        assert docs.columns == documents.columns, name
        counts.append(docs.count())
    assert counts[0] < documents.count() and counts[1] < counts[0]
    # One document of the planted family of near copies stays.
    family = {k for k, c in enumerate(corpus()) if 60 <= k < 76}
    assert docs.filter(F.col("doc_id").isin(*family)).select("doc_id").distinct().count() <= 2
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.count() > 0
    nothing.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "repeated_passages", "source_mix", "packing"
    ] and SCHEMA
