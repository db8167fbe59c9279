from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import rows

from reelstat import schemas
from reelstat.operators import content, neighbour_index, recommend, similarity

AS_OF = "2020-06-03"


def cosine(a, b):
    norm = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return round(sum(x * y for x, y in zip(a, b)) / norm, similarity.DECIMALS) if norm else 0.0


def brute(vectors):
    return {
        (m, n): cosine(a, b)
        for m, a in vectors.items()
        for n, b in vectors.items()
        if m != n and cosine(a, b) != 0
    }


def crowd(count=700, copies=0.35, seed=3):
    """Sparse vectors in which a third of the movies are identical and a feature is everywhere."""
    pick = random.Random(seed)
    vectors = {}
    for mid in pick.sample(range(10 * count), count):
        if pick.random() < copies:
            vectors[mid] = [1.0, 2.0] + [0.0] * 10
        else:
            vectors[mid] = [1.0] + [float(pick.random() < 0.2) for _ in range(11)]
    vectors[-1] = [0.0] * 12
    return vectors


@pytest.fixture
def vectors(table):
    return lambda values: table(list(values.items()), "mid long, vector array<double>")


def test_matrix_of_plain_vectors(vectors):
    frame = vectors({1: [1.0, 0.0], 2: [2.0, 0.0], 3: [0.0, 1.0], 4: [0.0, 0.0], 5: [-1.0, 0.0]})
    assert rows(similarity.similarity_matrix(frame)) == sorted(
        [(1, 2, 1.0), (2, 1, 1.0), (1, 5, -1.0), (5, 1, -1.0), (2, 5, -1.0), (5, 2, -1.0)], key=repr
    )


def test_empty_input(vectors):
    frame = vectors({1: [1.0]}).where("false")
    assert similarity.similarity_matrix(frame).count() == 0


@pytest.mark.parametrize("block_rows", [60, 10_000])
def test_matrix_equals_all_pairs(vectors, block_rows):
    values = crowd()
    found = {(r.mid, r.mid2): r.score for r in similarity.similarity_matrix(vectors(values), block_rows=block_rows).collect()}
    assert found == pytest.approx(brute(values), abs=1e-9)


@pytest.mark.parametrize("block_rows", [60, 10_000])
def test_nearest_equals_ranked_pairs(vectors, block_rows):
    values = crowd()
    best = {}
    for (mid, other), score in brute(values).items():
        if score > 0.1:
            best.setdefault(mid, []).append((-score, other))
    expected = sorted((m, i + 1, o) for m, s in best.items() for i, (_, o) in enumerate(sorted(s)[:30]))
    found = similarity.nearest_movies(vectors(values), 30, 0.1, block_rows)
    assert sorted(tuple(r) for r in found.select("mid", "rank", "mid2").collect()) == expected


def test_movies_of_equal_vectors_are_compared_once(table):
    pick = random.Random(9)
    kinds = [[float(pick.random() < 0.4) * pick.choice((1.0, 2.0)) for _ in range(6)] for _ in range(12)]
    values = [(m, pick.choice(kinds)) for m in pick.sample(range(5000), 400)]
    # Movies that come in several rows, of one vector or of two, rows without an id and without a vector.
    values += [(7001, kinds[0]), (7001, kinds[0]), (7002, kinds[1]), (7002, kinds[2]), (7003, kinds[0]), (7003, kinds[0])]
    frame = table([*values, (None, kinds[0]), (7004, None), (7005, [None, 1.0, 0.0])], "mid long, vector array<double>")
    values.append((7005, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0]))
    shapes = similarity._gathered(frame).shapes
    assert shapes.count() <= len({tuple(v) for _, v in values}) + 6 < 20
    best = {}
    for mid, a in values:
        near = [(-cosine(a, b), other) for other, b in values if other != mid and cosine(a, b) > 0.1]
        best.setdefault(mid, []).extend(sorted(near)[:30])
    expected = sorted((m, i + 1, o, -s) for m, near in best.items() for i, (s, o) in enumerate(sorted(near)[:30]))
    found = similarity.nearest_movies(frame, 30, 0.1, 10)
    assert sorted(tuple(r) for r in found.collect()) == [(*e[:3], pytest.approx(e[3], abs=1e-9)) for e in expected]


def test_single_precision_loses_no_pair(vectors):
    """Scores that differ by less than single precision tells, beside a list that is full."""
    pick = np.random.default_rng(4)
    base = pick.normal(size=24)
    values = {m: (base + pick.normal(size=24) * 10.0 ** -float(pick.integers(1, 7))).tolist() for m in range(500)}
    found = {}
    for r in similarity.nearest_movies(vectors(values), 5, 0.1, 40).collect():
        found.setdefault(r.mid, []).append((-r.score, r.mid2))
    for mid, a in values.items():
        wanted = sorted((-cosine(a, b), other) for other, b in values.items() if other != mid)[:5]
        assert [-s for s, _ in sorted(found[mid])] == pytest.approx([-s for s, _ in wanted], abs=2e-10)


def test_blocks_are_not_copied_for_their_pairs(vectors):
    """The blocks meet where they are stored: no exchange stands between them and their products."""
    plan = similarity.similarity_matrix(vectors(crowd(300)), block_rows=30)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_wide_vectors_get_smaller_blocks(vectors, monkeypatch):
    monkeypatch.setattr(similarity, "_CELLS", 12 * 50)
    values = crowd(count=400)
    found = {(r.mid, r.mid2): r.score for r in similarity.similarity_matrix(vectors(values), 0.3).collect()}
    expected = {pair: score for pair, score in brute(values).items() if score > 0.3}
    assert found == pytest.approx(expected, abs=1e-9)


def texts(pick, count=3000):
    """Sparse vectors as of texts: a few words of one topic, and one of many that all share."""
    out = {}
    for mid in range(count):
        topic = pick.randrange(40)
        vector = [0.0] * 401
        for _ in range(5):
            vector[topic * 10 + pick.randrange(10)] = pick.uniform(1, 3)
        vector[400] = 0.2
        out[mid] = vector
    return out


def test_pairs_of_blocks_are_left_out_without_a_loss(vectors):
    values = texts(random.Random(7), 900)
    placed = similarity.dealt(similarity._sparse(vectors(values)), 60).persist()
    blocks = placed.select("block").distinct().count()
    pairs = {(r.low, r.high) for r in similarity.block_pairs(placed, 0.1).collect()}
    assert 15 <= blocks <= 17 and len(pairs) < 0.5 * blocks * (blocks + 1) / 2
    # Strips of few blocks give the same pairs; with no threshold the shared feature lets all through.
    assert {(r.low, r.high) for r in similarity.block_pairs(placed, 0.1, strip_blocks=4).collect()} == pairs
    assert similarity.block_pairs(placed).count() == blocks * (blocks + 1) // 2
    of = {r.mid: r.block for r in placed.collect()}
    wanted = {pair: score for pair, score in brute(values).items() if score > 0.1}
    assert all((min(of[a], of[b]), max(of[a], of[b])) in pairs for a, b in wanted)
    found = {(r.mid, r.mid2): r.score for r in similarity.similarity_matrix(vectors(values), 0.1, block_rows=60).collect()}
    assert found == pytest.approx(wanted, abs=1e-9)


def test_a_leading_feature_fills_several_blocks(vectors):
    values = {m: [1.0, 0.0] for m in range(1000)} | {m: [0.1, 1.0] for m in range(1000, 1100)}
    sizes = similarity.dealt(similarity._sparse(vectors(values)), 100).groupBy("block").count().collect()
    assert len(sizes) == 11 and max(r["count"] for r in sizes) < 150


def test_rows_that_cannot_reach_the_threshold_take_no_part():
    block = similarity._Block(np.array([1, 2, 3]), np.array([0, 0, 1, 2]), np.array([0, 5, 5, 9]), np.array([0.6, 0.8, 1.0, 1.0]))
    other = similarity._Block(np.array([7]), np.array([0, 0]), np.array([5, 8]), np.array([0.3, 0.95]))
    kept = block.reaching(other, 0.25)
    assert kept.mids.tolist() == [2] and kept.row.tolist() == [0] and kept.feature.tolist() == [5]
    assert block.reaching(other, 0.2).mids.tolist() == [1, 2]


def info(table, *mids, off=()):
    return table(
        [(m, f"m{m}", f"i{m}", 7.0, "a b|c", int(m in off)) for m in mids],
        "mid long, movie_name string, img_urls string, rating_num double, categories string, off_shelf int",
    )


def test_similar_movies_from_pairs(table):
    pairs = table(
        [(1, 2, 0.9), (1, 3, 0.9), (1, 4, 0.1), (1, 5, float("nan")), (2, 1, 0.5)], schemas.SIMILARITY
    )
    found = similarity.similar_movies(pairs, info(table, 1, 2, 3, 4, 5), AS_OF, n=2)
    assert rows(found, "mid", "rank", "mid2", "hot_degree") == [(1, 1, 2, 0.0), (1, 2, 3, 0.0), (2, 1, 1, 0.0)]
    documents = {r.mid: r.simliarMovies for r in similarity.as_document(found).collect()}
    assert [m.mid for m in documents[1]] == [2, 3]
    assert documents[1][0].categories == "a|b|c"


def test_similarity_documents_are_cut_by_range(table):
    pairs = table([(1, m, 0.5) for m in range(2, 40)], schemas.SIMILARITY)
    parts = similarity.nest_similarity(pairs, AS_OF, width=10).collect()
    assert {len(p.mid2Score) for p in parts} == {8, 10}
    assert sorted(e.mid for p in parts for e in p.mid2Score) == list(range(2, 40))


MOVIE_TEXT = (
    "mid long, movie_name string, img_urls string, directors string, main_actors string, "
    "categories string, language string, location string"
)


def test_words(table):
    movies = table(
        [(1, "n", "i", "Bob", "Ann|Tim", "Drama", "en", "UK"), (2, "n", "i", None, "a", "b", "c", "d")],
        MOVIE_TEXT,
    )
    assert rows(content.movie_words(movies)) == [(1, "Bob Ann Tim Drama en UK")]
    assert rows(content.movie_words(movies, legacy_join=True)) == [(1, "Bob,Ann Tim,Drama,en,UK")]


def test_features_weigh_rare_words_higher(table):
    movies = table(
        [(m, "n", "i", f"director{m}", f"actor{m}", "Drama", "en", "UK") for m in range(1, 6)], MOVIE_TEXT
    )
    features = content.content_features(movies, num_features=1 << 14)
    weights = content.feature_weights(features).collect()
    assert {round(w.weight, 9) for w in weights} == {round(math.log(6 / 2), 9)}
    assert len(weights) == 10
    assert features.schema["vector"].dataType.simpleString() == "array<double>"


def recommended(events, history, pairs, on_shelf, n=30, recent=10):
    """The specification, row by row."""
    out = []
    for uid, mid in events:
        near = {b: s for (a, b), s in pairs.items() if a == mid}
        seen = sorted((h for h in history if h[0] == uid), key=lambda h: (h[3], h[1]), reverse=True)
        latest = seen[1 : recent + 1]
        fresh = sorted((-s, m) for m, s in near.items() if m not in {h[1] for h in seen})[:n]
        levels = []
        for _, candidate in fresh:
            kept = [(pairs.get((candidate, h[1]), 0.0), h[2]) for h in latest]
            kept = [(s, r) for s, r in kept if s >= 0]
            if kept:
                high = sum(r > 60 for _, r in kept)
                mean = sum(s * r for s, r in kept) / len(kept)
                level = mean + math.log10(max(high, 1)) - math.log10(max(len(kept) - high, 1))
                levels.append((-round(level, similarity.DECIMALS), candidate))
        listed = [entry for entry in sorted(levels) if entry[1] in on_shelf]
        out += [(uid, mid, i + 1, c, -level) for i, (level, c) in enumerate(listed)]
    return out


def directions(pick, movies):
    """Random vectors (mid, vector) and the rounded cosines of all pairs of them that are not 0."""
    vectors = [(m, [pick.choice((0.0, pick.uniform(-0.4, 1))) for _ in range(5)]) for m in movies]
    length = {m: math.sqrt(sum(x * x for x in v)) for m, v in vectors}
    pairs = {
        (a, b): round(sum(x * y for x, y in zip(v, w)) / length[a] / length[b], similarity.DECIMALS)
        for a, v in vectors for b, w in vectors if a != b and length[a] and length[b]
    }
    return vectors, {k: s for k, s in pairs.items() if s}


@pytest.fixture
def indexed(vectors, tmp_path_factory):
    """The folder of an index of (mid, vector) rows."""

    def build(values, **options):
        path = str(tmp_path_factory.mktemp("index") / "i")
        neighbour_index.build(vectors(dict(values)), path, **options)
        return path

    return build


def clustered(pick, groups=30, each=30, width=6):
    """Unit-like vectors around a few directions, a crowd of equal ones, and one of zeros."""
    out = {}
    for g in range(groups):
        middle = [pick.gauss(0, 1) for _ in range(width)]
        for k in range(each):
            out[g * each + k] = [x + pick.gauss(0, 0.05) for x in middle] if g else list(middle)
    out[-1] = [0.0] * width
    return out


@pytest.mark.parametrize("part", [neighbour_index.PART, 7])
def test_the_index_finds_exactly_the_nearest(spark, table, indexed, monkeypatch, part):
    monkeypatch.setattr(neighbour_index, "PART", part)
    values = clustered(random.Random(5))
    path = indexed(values)
    asked = {m: 3 + m % 50 for m in list(values)[::17]} | {-1: 4, 10**6: 4, 2: 895}
    found = {}
    for r in neighbour_index.search(spark, path, table(list(asked.items()), "mid long, depth long")).collect():
        found.setdefault(r.mid, []).append((r.place, r.mid2, r.score))
    pairs = brute(values)
    for mid, depth in asked.items():
        wanted = sorted((-s, b) for (a, b), s in pairs.items() if a == mid)[:depth]
        assert sorted(found.get(mid, [])) == [(k + 1, b, pytest.approx(-s, abs=1e-9)) for k, (s, b) in enumerate(wanted)]


def test_the_index_leaves_groups_out(spark, table, indexed):
    values = clustered(random.Random(5))
    path = indexed(values, centres=60)
    index = neighbour_index.centres(spark, path)
    units = spark.read.schema(neighbour_index.MEMBER).parquet(f"{path}/members").select("mid", "unit").where("mid % 9 = 0")
    asked = units.selectExpr("mid", "10L as depth", "unit", "0.9D as floor")
    first = neighbour_index.visits(asked, index, again=False).count()
    second = neighbour_index.visits(asked, index, again=True).count()
    assert asked.count() <= first and first + second < 0.4 * asked.count() * len(index.group)
    everything = "Cartesian" not in neighbour_index.search(spark, path, asked.select("mid", "depth"))._jdf.queryExecution().toString()
    assert everything
    # Members of one group are read from few row groups: the condition reaches the files.
    plan = spark.read.schema(neighbour_index.MEMBER).parquet(f"{path}/members").where("group = 3")._jdf.queryExecution().toString()
    assert "EqualTo(group,3)" in plan


def test_a_search_in_small_blocks_finds_the_same(spark, table, indexed, monkeypatch):
    """Asked movies of very different depths, members and places in many blocks, and movies that come twice."""
    pick = random.Random(8)
    values = [(m, [pick.gauss(0, 1) for _ in range(4)]) for m in range(120)]
    path = indexed(values)
    asked = [(m, 1 + m % 3 if m % 10 else 119) for m in range(0, 120, 2)]
    wanted = rows(neighbour_index.search(spark, path, table(asked, "mid long, depth long")))
    assert len(wanted) == sum(depth for _, depth in asked)
    for name, small in (("ASKED", 7), ("PLACES", 100), ("HELD", 9)):
        monkeypatch.setattr(neighbour_index, name, small)
    assert rows(neighbour_index.search(spark, path, table(asked, "mid long, depth long"))) == wanted


def test_histories_of_requests_without_candidates_are_not_kept(table, indexed, monkeypatch):
    kept = []
    monkeypatch.setattr(recommend, "saved", lambda frame: kept.append(frame.columns and frame.persist()) or kept[-1])
    frame = recommend.realtime_recommend(
        table([(1, 1), (2, 77), (3, 9)], "uid long, mid long"),
        table([(u, m, 80.0, f"2020-01-{m:02d}") for u in (1, 2, 3) for m in (2, 3)], "uid long, mid long, rating double, date string"),
        indexed([(1, [1.0, 0.5]), (2, [1.0, 0.0]), (3, [0.5, 1.0]), (4, [1.0, 1.0]), (9, [0.0, 0.0])]),
        info(table, 1, 2, 3, 4),
        AS_OF,
    )
    assert {(r.uid, r.rated_mid) for r in frame.collect()} == {(1, 1)}
    assert [(f.count(), {r.uid for r in f.select("uid").collect()}) for f in kept[:2]] == [(1, {1}), (2, {1})]


def test_an_index_of_nothing(spark, table, indexed):
    path = indexed({1: [0.0, 0.0]})
    assert neighbour_index.search(spark, path, table([(1, 3)], "mid long, depth long")).count() == 0


def test_a_user_of_very_many_ratings_finds_the_deep_places(table, indexed):
    pick = random.Random(2)
    movies = range(1, 1400)
    vectors = [(m, [1.0, m / 1400]) for m in movies]
    history = [(1, m, float(pick.randrange(2, 101)), f"2020-01-{1 + m % 28:02d}") for m in range(1, 1350)]
    frame = recommend.realtime_recommend(
        table([(1, 5), (2, 5)], "uid long, mid long"),
        table(history + [(2, 3, 50.0, "2020-01-01"), (2, 4, 50.0, "2020-01-02")], "uid long, mid long, rating double, date string"),
        indexed(vectors),
        info(table, *movies),
        AS_OF,
    )
    found = rows(frame, "uid", "mid")
    assert {m for u, m in found if u == 1} == set(range(1350, 1380))
    assert {m for u, m in found if u == 2} == {1, 2, *range(6, 34)}


def test_recommendations_follow_the_specification(table, indexed):
    pick = random.Random(11)
    movies = range(1, 120)
    vectors, pairs = directions(pick, movies)
    # User 0 holds a third of all ratings; movie 5 gets a third of all events.
    history = [
        (0 if pick.random() < 0.33 else pick.randrange(1, 9), pick.choice(movies), float(pick.randrange(2, 101)), f"2020-01-{pick.randrange(1, 29):02d}")
        for _ in range(200)
    ]
    history = list({(h[0], h[1], h[3]): h for h in history}.values())
    events = sorted({(u, 5 if pick.random() < 0.33 else pick.choice(movies)) for u in range(9) for _ in range(4)})
    off = {7, 8, 9}
    frame = recommend.realtime_recommend(
        table(events, "uid long, mid long"),
        table(history, "uid long, mid long, rating double, date string"),
        indexed(vectors),
        info(table, *movies, off=off),
        AS_OF,
    )
    found = sorted(tuple(r) for r in frame.select("uid", "rated_mid", "rank", "mid", "score").collect())
    expected = sorted(recommended(events, history, pairs, set(movies) - off))
    assert [f[:4] for f in found] == [e[:4] for e in expected]
    assert [f[4] for f in found] == pytest.approx([e[4] for e in expected], abs=1e-9)


def test_recommendations_need_history_and_repeat_with_the_event(table, indexed):
    # Cosines: 1 and 2 0.5, 1 and 3 0.4, 2 and 8 0.6.
    vectors = indexed(
        [
            (1, [1.0, 0.0, 0.0, 0.0, 0.0]), (2, [0.5, 0.6, 0.39**0.5, 0.0, 0.0]), (3, [0.4, 0.0, 0.0, 0.84**0.5, 0.0]),
            (8, [0.0, 1.0, 0.0, 0.0, 0.0]), (9, [0.0, 0.0, 0.0, 0.0, 1.0]),
        ]
    )
    history = [(10, 9, 80.0, "2020-01-01")] + [(20, m, 90.0, f"2020-01-{m:02d}") for m in (8, 9)]
    frame = recommend.realtime_recommend(
        table([(10, 1), (20, 1), (20, 1), (30, 1), (20, 77)], "uid long, mid long"),
        table(history, "uid long, mid long, rating double, date string"),
        vectors,
        info(table, 1, 2, 3, off=(3,)),
        AS_OF,
    )
    found = rows(frame, "uid", "rated_mid", "copy", "rank", "mid", "score")
    assert found == [(20, 1, 1, 1, 2, 54.0), (20, 1, 2, 1, 2, 54.0)]
    documents = recommend.as_document(frame).collect()
    assert len(documents) == 2 and [m.mid for m in documents[0].userResc] == [2]
