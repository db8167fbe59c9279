from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reelstat.functions import times
from reelstat.operators import leaderboards, popularity

AS_OF = "2020-06-03"

MOVIES = (
    "mid long, movie_name string, img_urls string, categories string, release_date string, "
    "location string, rating_num double"
)


def movie(mid, categories="剧情", release="2020-06-03", location="中国大陆", rating=8.0):
    return (mid, f"m{mid}", f"i{mid}", categories, release, location, rating)


def ids(table, *mids):
    return table([(m,) for m in mids], "mid long")


def counted(table, movies, ratings=(), comments=(), collections=(), plays=()):
    parts = [table([(m,) for m in p], "mid long") for p in (ratings, comments, collections, plays)]
    return popularity.movie_activity_counts(table(movies, MOVIES), *parts)


def test_hot_degree_of_a_new_movie(table):
    counts = counted(table, [movie(1)], [1] * 3, [1] * 2, [1], [1] * 10)
    [(score,)] = rows(popularity.hot_degree(counts, AS_OF), "hot_degree")
    assert score == pytest.approx(1.0 + 0.2 + 0.2 + 10 / 2**1.8)


def test_hot_degree_without_activity_and_with_future_release(table):
    counts = counted(table, [movie(1), movie(2, release="2031-01-01")], [], [], [], [2])
    found = dict(rows(popularity.hot_degree(counts, AS_OF), "mid", "hot_degree"))
    assert found[1] == pytest.approx(-0.5)
    assert found[2] == pytest.approx(-0.5 + 1 / 2**1.8)


def test_only_full_release_dates_count(table):
    releases = [None, "1994", "1994(US)xx", "1994-09-10(CA)", "not-a-date"]
    movies = [movie(i, release=r) for i, r in enumerate(releases)]
    assert rows(popularity.hot_degree(counted(table, movies), AS_OF), "mid") == [(3,)]


def test_counts_are_zero_without_activity_and_categories_are_required(table):
    counts = counted(table, [movie(1), movie(2, categories=None)], [1, 1, 2, 9], [1])
    assert rows(counts, "mid", *popularity.COUNTS) == [(1, 2, 1, 0, 0)]


def test_deleted_rows_count_unless_excluded(table):
    movies = table([movie(1)], MOVIES)
    comments = table([(1, 0), (1, 1), (1, None)], "mid long, deleted int")
    none = ids(table)
    every = popularity.movie_activity_counts(movies, none, comments, none, none)
    kept = popularity.movie_activity_counts(movies, none, comments, none, none, exclude_deleted=True)
    assert rows(every, "comment_count") == [(3,)]
    assert rows(kept, "comment_count") == [(2,)]


def hot(table, entries):
    """(mid, hot_degree, categories, location) as scored movies."""
    return table(
        [(m, f"m{m}", c, h, l, f"i{m}", 7.5) for m, h, c, l in entries],
        "mid long, movie_name string, categories string, hot_degree double, location string, "
        "img_urls string, rating_num double",
    )


def test_categories_are_exploded_and_ties_go_to_the_lower_id(table):
    scored = hot(table, [(2, 5.0, "a|b", "x"), (1, 5.0, "a", "x"), (3, 9.0, "b", "x")])
    board = leaderboards.top_movies_by_category(scored, AS_OF, n=2)
    assert rows(board, "category", "rank", "mid") == [
        ("a", 1, 1),
        ("a", 2, 2),
        ("b", 1, 3),
        ("b", 2, 2),
    ]
    document = leaderboards.as_document(board)
    assert {r.category: [m.mid for m in r.movieList] for r in document.collect()} == {
        "a": [1, 2],
        "b": [3, 2],
    }


def test_movies_and_comics_split_on_the_tag(table):
    scored = hot(table, [(1, 1.0, "动画|喜剧", "x"), (2, 2.0, "喜剧", "x"), (3, 3.0, "剧情", "x")])
    assert rows(leaderboards.top_comics(scored, AS_OF), "mid") == [(1,)]
    assert rows(leaderboards.top_movies(scored, AS_OF), "rank", "mid") == [(1, 3), (2, 2)]


def test_regions(table):
    scored = hot(
        table, [(1, 1.0, "a", "美国 / 英国"), (2, 2.0, "a", "中国大陆"), (3, 3.0, "a", None), (4, 4.0, "a", "法国")]
    )
    north = leaderboards.region_ranking(scored, AS_OF, "north_america")
    mainland = leaderboards.region_ranking(scored, AS_OF, "mainland_ranking")
    every = leaderboards.region_ranking(scored, AS_OF)
    assert rows(north, "rank", "mid") == [(1, 4), (2, 1)]
    assert rows(mainland, "category", "mid") == [("mainland_ranking", 2)]
    assert [r.mid for r in every.orderBy("rank").collect()] == [4, 3, 2, 1]


def test_good_ranking_prefers_newer_movies_among_equals(table):
    movies = table(
        [movie(1, release="2001-01-01", rating=9.0), movie(2, release="2010-01-01", rating=9.0),
         movie(3, rating=9.5), movie(4, categories=None, rating=10.0)],
        MOVIES,
    )
    board = leaderboards.good_ranking(movies, AS_OF)
    assert [r.mid for r in board.orderBy("rank").collect()] == [3, 2, 1]
    assert {r.hot_degree for r in board.collect()} == {0.0}


def test_week_and_month_borders(table):
    movies = table([movie(1), movie(2, categories=None)], MOVIES)
    dates = ["2020-06-01 00:00:00", "2020-06-07 23:59:58", "2020-06-07 23:59:59", "2020-06-08", "2020-05-31"]
    ratings = table([(1, d) for d in dates] + [(2, "2020-06-02")], "mid long, date string")
    week = leaderboards.top_movies_of_period(movies, ratings, AS_OF, "week")
    month = leaderboards.top_movies_of_period(movies, ratings, AS_OF, "month")
    assert rows(week, "rank", "mid", "rating_count") == [(1, 1, 2), (2, 2, 1)]
    assert rows(month, "rank", "mid", "rating_count") == [(1, 1, 4), (2, 2, 1)]


def test_period_filter_reaches_the_scan(spark, table, tmp_path):
    path = str(tmp_path / "ratings")
    table([(1, "2020-06-02")], "mid long, date string").write.parquet(path)
    kept = spark.read.parquet(path).where(leaderboards.in_period(F.col("date"), AS_OF, "week"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2020-06-01)" in plan


def test_dates():
    assert times.week_of("2001-07-31") == (dt.date(2001, 7, 30), dt.date(2001, 8, 5))
    assert times.epoch_ms("1970-01-02") == 86_400_000
