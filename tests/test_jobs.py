"""Whole jobs on the smallest data: every result table is written and holds what its operator gives."""

from __future__ import annotations

import pytest
from conftest import rows

import __spark_entry__ as entry
from reelstat.operators import neighbour_index, sessions
from reelstat.params import JobParams
from reelstat.plans import jobs
from reelstat.plans.domain import AS_OF, Domain


@pytest.fixture
def domain(spark):
    return Domain(spark, entry.SMALL)


def test_leaderboards(spark, domain, tmp_path):
    out = str(tmp_path)
    for _ in range(2):
        jobs.run_leaderboards(
            domain.movies, domain.movie_ratings, domain.comments, domain.collections, domain.plays, AS_OF, out
        )
    ranking = spark.read.parquet(f"{out}/multiple_ranking")
    assert ranking.where("category = 'hot_ranking'").count() == 2
    [first, second] = ranking.where("category = 'good_ranking'").collect()
    assert first.movieList == second.movieList and len(first.movieList) == 10
    best = spark.read.parquet(f"{out}/top_movies").first().movieList
    degrees = [m.hotDegree for m in best]
    assert degrees == sorted(degrees, reverse=True)
    assert spark.read.parquet(f"{out}/top_movies_of_category").select("category").distinct().count() > 10
    for name in ("top_movies_of_month", "top_movies_of_week"):
        assert len(spark.read.parquet(f"{out}/{name}").first().movieList) == 10


def test_similarity(spark, domain, tmp_path):
    jobs.run_similarity(domain.movies, AS_OF, str(tmp_path), n=5)
    documents = spark.read.parquet(f"{tmp_path}/similar_movies").collect()
    assert documents and all(len(d.simliarMovies) <= 5 for d in documents)
    stored = spark.read.parquet(f"{tmp_path}/mid2_similar_score")
    assert stored.select("mid").distinct().count() == 200
    # A movie keeps its nearest movies, not a row of a matrix; the index answers for the rest.
    assert stored.selectExpr("max(size(mid2Score))").first()[0] == 5
    one = documents[0]
    asked = spark.createDataFrame([(one.mid, 5)], "mid long, depth long")
    found = neighbour_index.search(spark, f"{tmp_path}/neighbour_index/date={AS_OF}", asked).orderBy("place").collect()
    assert [r.mid2 for r in found] == [m.mid for m in one.simliarMovies]


def test_sessions(spark, domain, tmp_path):
    params = JobParams(sex=1)
    jobs.run_sessions(domain.actions, domain.users, AS_OF, str(tmp_path), params)
    kept = sessions.session_filter(sessions.session_aggregate(domain.actions, domain.users), sex=1)
    stats = spark.read.parquet(f"{tmp_path}/session_stats").first().statisticsMap
    assert stats["session_count"] == kept.count()
    detail = sessions.actions_of_sessions(domain.actions, kept)
    expected = sessions.top_categories(detail, AS_OF)
    columns = ("categoryId", "clickCount", "rank")
    assert rows(spark.read.parquet(f"{tmp_path}/top_categories"), *columns) == rows(expected, *columns)
    assert spark.read.parquet(f"{tmp_path}/top_sessions").count() > 0
    assert spark.read.parquet(f"{tmp_path}/top_session_details").count() > 0


def test_funnel_and_area(spark, domain, tmp_path):
    params = JobParams(start_date="1970-01-01", end_date="1971-01-01", top_movies=3)
    jobs.run_funnel(domain.actions, AS_OF, str(tmp_path), params)
    jobs.run_area(domain.actions, domain.cities, domain.movies, AS_OF, str(tmp_path), params)
    assert spark.read.parquet(f"{tmp_path}/page_convert_rate").count() == 1
    best = spark.read.parquet(f"{tmp_path}/top_movies_of_area")
    assert best.agg({"rank": "max"}).first()[0] == 3
