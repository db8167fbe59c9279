"""Complete batch jobs: inputs to appended result tables.

A result that later steps use again is written first and read back. That cuts the lineage
durably, and the planner then knows its real size when it chooses join strategies.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from reelstat.functions import times
from reelstat.operators import area, content, funnel, leaderboards, neighbour_index, popularity, sessions, similarity
from reelstat.params import JobParams
from reelstat.session import scratch_path
from reelstat.sinks.tables import append_table


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """Write an intermediate frame to the shared folder and read it back."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def run_leaderboards(
    movies: DataFrame,
    ratings: DataFrame,
    comments: DataFrame,
    collections: DataFrame,
    plays: DataFrame,
    as_of: dt.date | str,
    out: str,
    n: int = 10,
) -> None:
    """Score all movies once and append every leaderboard."""
    counts = popularity.movie_activity_counts(movies, ratings, comments, collections, plays)
    hot = _stored(popularity.hot_degree(counts, as_of), "hot")
    boards = {
        "top_movies_of_category": leaderboards.top_movies_by_category(hot, as_of, n),
        "top_movies": leaderboards.top_movies(hot, as_of, n=n),
        "top_comics": leaderboards.top_comics(hot, as_of, n=n),
        "top_movies_of_month": leaderboards.top_movies_of_period(movies, ratings, as_of, "month", n),
        "top_movies_of_week": leaderboards.top_movies_of_period(movies, ratings, as_of, "week", n),
    }
    for name, board in boards.items():
        append_table(leaderboards.as_document(board), f"{out}/{name}")
    for board in (
        leaderboards.region_ranking(hot, as_of, "hot_ranking", n=n),
        leaderboards.region_ranking(hot, as_of, "north_america", n=n),
        leaderboards.region_ranking(hot, as_of, "mainland_ranking", n=n),
        leaderboards.good_ranking(movies, as_of, n),
    ):
        append_table(leaderboards.as_document(board), f"{out}/multiple_ranking")


def run_similarity(
    movies: DataFrame, as_of: dt.date | str, out: str, num_features: int = 500, n: int = 30
) -> None:
    """Append the similarities above the threshold, the similar movies of every movie, and an index of the vectors.

    The similarity of any other pair is computed from the index when it is asked for; no matrix is written.
    """
    features = content.content_features(movies, num_features).select("mid", "vector")
    vectors = _stored(features, "features")
    nearest = _stored(similarity.nearest_movies(vectors, n), "nearest")
    pairs = nearest.select("mid", "mid2", "score")
    append_table(similarity.nest_similarity(pairs, as_of), f"{out}/mid2_similar_score")
    append_table(similarity.as_document(similarity.with_info(nearest, movies, as_of)), f"{out}/similar_movies")
    neighbour_index.build(vectors, f"{out}/neighbour_index/date={times.as_text(as_of)}")


def _chosen(actions: DataFrame, params: JobParams) -> DataFrame:
    if params.start_date is None or params.end_date is None:
        return actions
    return sessions.actions_between(
        actions, params.start_date, params.end_date, params.inclusive_end_day
    )


def run_sessions(
    actions: DataFrame, users: DataFrame, as_of: dt.date | str, out: str, params: JobParams
) -> None:
    """Filter sessions; append their length statistics, top categories, top sessions, details."""
    chosen = _chosen(actions, params)
    matching = sessions.filtered_counters(
        chosen,
        users,
        params.age,
        params.cities,
        params.professions,
        params.sex,
        params.categories,
    )
    # Nothing below needs the keywords.
    kept = _stored(matching.select("sessionId", "visitLength", "stepLength"), "sessions")
    stats = sessions.session_length_stats(kept, as_of, params.visit_buckets, params.step_buckets)
    append_table(sessions.stats_document(stats), f"{out}/session_stats")

    detail = _stored(sessions.actions_of_sessions(chosen, kept), "actions")
    top = _stored(sessions.top_categories(detail, as_of), "categories")
    append_table(top, f"{out}/top_categories")
    best = _stored(sessions.top_sessions_of_category(detail, top, as_of), "top-sessions")
    append_table(best, f"{out}/top_sessions")
    append_table(sessions.session_details(detail, best, as_of), f"{out}/top_session_details")


def run_funnel(actions: DataFrame, as_of: dt.date | str, out: str, params: JobParams) -> None:
    """Append the page conversion rates."""
    rates = funnel.page_convert_rate(_chosen(actions, params), as_of)
    append_table(rates, f"{out}/page_convert_rate")


def run_area(
    actions: DataFrame,
    cities: DataFrame,
    movies: DataFrame,
    as_of: dt.date | str,
    out: str,
    params: JobParams,
) -> None:
    """Append the top movies of every city."""
    best = area.top_movies_of_area(_chosen(actions, params), cities, movies, as_of, params.top_movies)
    append_table(best, f"{out}/top_movies_of_area")
