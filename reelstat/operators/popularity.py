"""Activity counts per movie and the popularity score built from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from reelstat.functions import scores, times

COUNTS = ("rating_count", "comment_count", "collection_count", "play_count")
INFO = ("img_urls", "rating_num")


def movie_activity_counts(
    movies: DataFrame,
    ratings: DataFrame,
    comments: DataFrame,
    collections: DataFrame,
    plays: DataFrame,
    exclude_deleted: bool = False,
) -> DataFrame:
    """Ratings, comments, collections and plays of every movie that has categories.

    The four activity tables are counted in one pass: their movie ids are tagged, stacked and
    summed with map-side combining, so one shuffle of at most one row per task and movie
    replaces four, and a movie that holds most of the rows costs no more than any other.
    """
    tables = dict(zip(COUNTS, (ratings, comments, collections, plays)))
    stacked = None
    for kind, table in tables.items():
        if exclude_deleted and "deleted" in table.columns:
            table = table.where(F.coalesce("deleted", F.lit(0)) == 0)
        tagged = table.select("mid", F.lit(kind).alias("kind"))
        stacked = tagged if stacked is None else stacked.unionAll(tagged)
    counted = stacked.groupBy("mid").agg(
        *[F.count_if(F.col("kind") == kind).alias(kind) for kind in COUNTS]
    )
    return (
        movies.where(F.col("categories").isNotNull())
        .select("mid", "movie_name", "categories", "release_date", "location", *INFO)
        .join(counted, "mid", "left")
        .na.fill(0, list(COUNTS))
    )


def hot_degree(
    counts: DataFrame,
    as_of: dt.date | str,
    weights: Sequence[float] = scores.HOT_WEIGHTS,
    gravity: float = scores.HOT_GRAVITY,
) -> DataFrame:
    """Popularity of every movie with a usable release date. No shuffle."""
    released = counts.withColumn("_released", times.release_day(F.col("release_date")))
    score = scores.hot_degree(
        *[F.col(c) for c in COUNTS],
        times.hours_since(F.col("_released"), as_of),
        weights=weights,
        gravity=gravity,
    )
    return released.where(F.col("_released").isNotNull()).select(
        "mid", "movie_name", "categories", score.alias("hot_degree"), "location", *INFO
    )
