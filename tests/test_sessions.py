from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reelstat import schemas
from reelstat.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS, bucket_label, parse_buckets
from reelstat.operators import area, funnel, sessions
from reelstat.params import JobParams, load_properties

AS_OF = "2020-06-03"

FIELDS = schemas.ACTIONS.fieldNames()


def action(date, session="s", user=1, **values):
    filled = {"date": date, "sessionId": session, "userId": user, **values}
    return tuple(filled.get(name) for name in FIELDS)


@pytest.fixture
def actions(table):
    return lambda *entries: table(list(entries), schemas.ACTIONS)


@pytest.fixture
def users(table):
    return table(
        [(1, "a", "a", 30, "teacher", "北京", 1), (2, "b", "b", 40, "doctor", "上海", 0)], schemas.USERS
    )


def test_session_is_folded(actions, users):
    found = sessions.session_aggregate(
        actions(
            action(1000, searchKeyword="x", clickCategoryId=10),
            action(3500, clickCategoryId=9),
            action(6000, searchKeyword="x"),
            action(5, session="unknown user", user=99),
        ),
        users,
    )
    [row] = found.collect()
    assert (row.stepLength, row.visitLength, row.startTime) == (3, 5000, 1000)
    assert (row.searchKeywords, row.clickCategoryIds) == ("x", "9-10")
    assert (row.age, row.professional, row.city, row.sex) == (30, "teacher", "北京", 1)


def test_values_of_a_session_lie_in_bounded_parts(spark, users):
    n = 1_000_000
    many = spark.range(n).selectExpr(
        "1000 + id as date", "1L as userId", "'s' as sessionId", "concat('w', lpad(id % 1000000, 7, '0')) as searchKeyword",
        "if(id % 3 = 0, id % 12 - 2, null) as clickCategoryId",
    )
    parts = sessions.session_values(many.unionByName(many)).cache()
    assert parts.where("kind = 'keyword'").count() == n // sessions.PART_VALUES
    assert parts.selectExpr("max(size(values))").first()[0] == sessions.PART_VALUES
    [categories] = parts.where("kind = 'category'").collect()
    assert list(categories["values"]) == ["-2", "1", "4", "7"] and categories.part == 0
    [folded] = sessions.session_aggregate(many, users).collect()
    words = folded.searchKeywords.split("-")
    assert len(words) == n and words == sorted(words) and folded.stepLength == n
    assert folded.clickCategoryIds == "-2-1-4-7" and folded.categories == [-2, 1, 4, 7]


def test_filters(actions, users):
    found = sessions.session_aggregate(
        actions(
            action(1, session="a", user=1, clickCategoryId=5),
            action(1, session="b", user=2, clickCategoryId=6),
            action(1, session="c", user=2),
        ),
        users,
    )

    def kept(**conditions):
        return [r[0] for r in rows(sessions.session_filter(found, **conditions), "sessionId")]

    assert kept() == ["a", "b", "c"]
    assert kept(age=(30, 39)) == ["a"]
    assert kept(cities=["上海"]) == ["b", "c"]
    assert kept(professions=["teacher"]) == ["a"]
    assert kept(sex=0) == ["b", "c"]
    assert kept(categories=[6, 7]) == ["b"]


def test_counters_of_filtered_sessions(actions, users):
    some = actions(
        action(1, clickCategoryId=3), action(5, clickCategoryId=4), action(7, session="t", clickCategoryId=9),
        action(2, session="u", user=2, clickCategoryId=3),
    )
    for conditions in ({}, {"sex": 1}, {"categories": (3, 8)}, {"age": (35, 50), "categories": (3,)}, {"categories": ()}):
        whole = sessions.filtered_sessions(some, users, **conditions)
        found = sessions.filtered_counters(some, users, **conditions)
        assert rows(found, "sessionId", *sessions.COUNTED) == rows(whole, "sessionId", *sessions.COUNTED)


def test_date_range(actions):
    day = 86_400_000
    base = actions(action(0), action(day), action(day + 1), action(2 * day))
    assert sessions.actions_between(base, "1970-01-01", "1970-01-02").count() == 2
    assert sessions.actions_between(base, "1970-01-01", "1970-01-02", True).count() == 3


def test_buckets_take_the_first_match(table):
    frame = table([(0,), (3,), (10,), (30,), (31,), (1801,)], "v long")
    visit = frame.select("v", bucket_label(F.col("v"), VISIT_BUCKETS).alias("b"))
    assert dict(rows(visit)) == {0: None, 3: "1s_3s", 10: "10s_30s", 30: "10s_30s", 31: "30s_60s", 1801: "30m"}
    step = table([(10,), (61,)], "v long").select("v", bucket_label(F.col("v"), STEP_BUCKETS))
    assert dict(rows(step)) == {10: "10_30", 61: "60"}


def test_length_stats(table):
    frame = table([(3500, 10), (30_000, 2), (0, 1)], "visitLength long, stepLength long")
    stats = dict(rows(sessions.session_length_stats(frame, AS_OF), "key", "value"))
    assert stats["session_count"] == 3
    assert stats["visit_length_ratio_1s_3s"] == pytest.approx(1 / 3)
    assert stats["visit_length_ratio_10s_30s"] == pytest.approx(1 / 3)
    assert stats["step_length_ratio_10_30"] == pytest.approx(1 / 3)
    assert stats["step_length_ratio_1_3"] == pytest.approx(2 / 3)
    assert len(stats) == 1 + len(VISIT_BUCKETS) + len(STEP_BUCKETS)
    empty = sessions.session_length_stats(frame.where("false"), AS_OF)
    assert {r.value for r in empty.collect()} == {0.0}
    [document] = sessions.stats_document(sessions.session_length_stats(frame, AS_OF)).collect()
    assert document.statisticsMap == stats


def test_top_categories_compare_numbers(actions):
    entries = [action(i, clickCategoryId=7) for i in range(9)]
    entries += [action(i, clickCategoryId=8) for i in range(10)]
    entries += [action(1, commentCategoryId=3), action(2, collectCategoryId=4)]
    best = sessions.top_categories(actions(*entries), AS_OF, 3)
    assert [r.categoryId for r in best.orderBy("rank").collect()] == [8, 7, 4]


def test_top_sessions_and_details(actions):
    entries = [action(i, session="long", clickCategoryId=1) for i in range(10)]
    entries += [action(i, session="short", clickCategoryId=1) for i in range(9)]
    entries += [action(50, session="both", clickCategoryId=1, commentCategoryId=2)]
    entries += [action(60, session="none", clickCategoryId=0)]
    base = actions(*entries)
    top = sessions.top_categories(base, AS_OF, 2)
    best = sessions.top_sessions_of_category(base, top, AS_OF, 2)
    assert rows(best, "categoryId", "rank", "sessionId", "count") == [(1, 1, "long", 10), (1, 2, "short", 9)]
    doubled = best.unionAll(best)
    details = sessions.session_details(base, doubled, AS_OF)
    assert details.count() == 19
    assert details.columns == ["date", *sessions.DETAIL]


def test_funnel_skips_unknown_pages(actions):
    pages = ["/index", "/movie/detail", "/other", "/play", None]
    entries = [action(i, pageId=p) for i, p in enumerate(pages)]
    entries += [action(1, session="t", pageId="/about")]
    found = dict(rows(funnel.page_transitions(actions(*entries))))
    assert found["index_detail"] == 1 and found["detail_play"] == 1
    assert found["index"] == 1 and found["detail"] == 1
    [rate] = funnel.page_convert_rate(actions(*entries), AS_OF).collect()
    assert (rate.indexToDetail, rate.detailToPlay, rate.detailToComment) == (1.0, 1.0, 0.0)
    [none] = funnel.page_convert_rate(actions(action(1, pageId="/about")), AS_OF).collect()
    assert none.indexToDetail == 0.0


def test_funnel_of_a_session_cut_into_pieces(table):
    """A session that holds most rows, over many pieces, gives the same steps as one list."""
    pick = random.Random(7)
    names = ["index", "detail", "comment", "rating", "collect", "play", "zzz"]
    entries = [
        (pick.randrange(5000), "hot" if pick.random() < 0.6 else f"s{pick.randrange(9)}", pick.choice(names), i)
        for i in range(800)
    ]
    expected = dict.fromkeys(funnel.KEYS, 0)
    for session in {e[1] for e in entries}:
        seen = [e[2] for e in sorted((e for e in entries if e[1] == session), key=lambda e: (e[0], e[3])) if e[2] != "zzz"]
        for key in seen:
            if key in expected:
                expected[key] += 1
        for a, b in zip(seen, seen[1:]):
            if f"{a}_{b}" in expected:
                expected[f"{a}_{b}"] += 1
    frame = table(entries, "date long, sessionId string, pageId string, n int")
    for piece in (1, 70, 1_000_000):
        assert dict(rows(funnel.page_transitions(frame, ("n",), piece))) == expected


def test_area_counts_a_user_once(actions, table):
    entries = [
        action(1, user=1, cityId=10, clickMovieId=5),
        action(2, user=1, cityId=10, clickMovieId=5),
        action(3, user=2, cityId=10, clickMovieId=0, collectMovieId=5),
        action(4, user=2, cityId=10, ratingMovieId=6),
        action(5, user=3, cityId=10),
    ]
    cities = table([(10, "长沙")], "id int, name string")
    movies = table([(5, "five"), (6, "six")], "mid long, movie_name string")
    best = area.top_movies_of_area(actions(*entries), cities, movies, AS_OF, 5)
    assert rows(best, "rank", "cityName", "movieName", "count") == [(1, "长沙", "five", 2), (2, "长沙", "six", 1)]
    assert area.top_movies_of_area(actions(*entries), cities, movies, AS_OF, 1).count() == 1


def test_parameters_from_a_property_file(tmp_path):
    path = tmp_path / "session.properties"
    path.write_text(
        "# filters\nfilter.start.date=2020-06-01\nfilter.age = 20-30\nfilter.sex=1\n"
        "filter.cities=北京,上海\nfilter.categories=1,2\nsession.visitLength=1-3,60\ntop.movies.count=5\n",
        encoding="utf-8",
    )
    params = JobParams.from_properties(load_properties(str(path)))
    assert params.start_date == "2020-06-01" and params.end_date is None
    assert params.age == (20, 30) and params.sex == 1 and params.cities == ("北京", "上海")
    assert params.categories == (1, 2) and params.top_movies == 5
    assert params.visit_buckets == parse_buckets("1-3,60") and params.step_buckets == STEP_BUCKETS
