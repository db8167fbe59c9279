"""Top movies: overall, per category, region, rating, month and week.

All take the scored movies of :func:`popularity.hot_degree` (or the raw movies) and return one
row per place. :func:`as_document` folds them into one list per board.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reelstat.functions import ranking, text, times

ENTRY = ("mid", "movie_name", "hot_degree", "img_urls", "rating_num", "categories")

# The tag of animated movies and the places of the two regional boards.
ANIMATION_TAG = "动画"
NORTH_AMERICA = ("美国", "法国", "加拿大", "西班牙", "意大利")
MAINLAND = ("大陆",)
REGIONS = {"north_america": NORTH_AMERICA, "mainland_ranking": MAINLAND, "hot_ranking": None}


def _heat_order() -> list[Column]:
    return [F.desc("hot_degree"), F.asc("mid")]


def _dated(frame: DataFrame, as_of: dt.date | str, *keys: Column) -> DataFrame:
    return frame.select(F.lit(times.as_text(as_of)).alias("date"), *keys, "rank", *ENTRY)


def as_document(board: DataFrame) -> DataFrame:
    """One row per board with its movies as a list in rank order."""
    keys = [c for c in ("date", "category") if c in board.columns]
    return ranking.nest(board, keys, ENTRY, "movieList")


def top_movies_by_category(hot: DataFrame, as_of: dt.date | str, n: int = 10) -> DataFrame:
    """The hottest movies of each category."""
    tagged = hot.withColumn("category", F.explode(text.category_list(F.col("categories"))))
    return _dated(
        ranking.top_n_per_group(tagged, ["category"], _heat_order(), n), as_of, F.col("category")
    )


def top_movies(
    hot: DataFrame, as_of: dt.date | str, animation_tag: str = ANIMATION_TAG, n: int = 10
) -> DataFrame:
    """The hottest movies that are not animation."""
    kept = hot.where(~F.col("categories").contains(animation_tag))
    return _dated(ranking.top_n(kept, _heat_order(), n), as_of)


def top_comics(
    hot: DataFrame, as_of: dt.date | str, animation_tag: str = ANIMATION_TAG, n: int = 10
) -> DataFrame:
    """The hottest animation."""
    kept = hot.where(F.col("categories").contains(animation_tag))
    return _dated(ranking.top_n(kept, _heat_order(), n), as_of)


def region_ranking(
    hot: DataFrame,
    as_of: dt.date | str,
    category: str = "hot_ranking",
    location_terms: Sequence[str] | None = None,
    n: int = 10,
) -> DataFrame:
    """The hottest movies of a region; ``hot_ranking`` without terms covers every place."""
    terms = REGIONS.get(category) if location_terms is None else location_terms
    kept = hot if terms is None else hot.where(text.contains_any(F.col("location"), terms))
    board = ranking.top_n(kept, _heat_order(), n)
    return _dated(board, as_of, F.lit(category).alias("category"))


def good_ranking(movies: DataFrame, as_of: dt.date | str, n: int = 10) -> DataFrame:
    """Best rated movies, newer ones first among equals."""
    rated = movies.where(F.col("categories").isNotNull()).withColumn("hot_degree", F.lit(0.0))
    order = [F.desc("rating_num"), F.desc("release_date"), F.asc("mid")]
    return _dated(ranking.top_n(rated, order, n), as_of, F.lit("good_ranking").alias("category"))


def in_period(date: Column, as_of: dt.date | str, period: str, kind: str = "string") -> Column:
    """Whether a date lies in the month or the Monday-to-Sunday week of ``as_of``.

    ``kind`` is the type of the column: ``string``, ``date`` or a timestamp. All become plain ranges of literals, so that
    the filter reaches the scan. ``yyyy-MM-dd`` and ``yyyy-MM-dd HH:mm:ss`` strings both sort correctly.
    """
    start, end = times.period_bounds(as_of, period)
    if kind == "string":
        if period == "month":
            return date.startswith(f"{start:%Y-%m}")
        return (date >= f"{start:%Y-%m-%d}") & (date < f"{end:%Y-%m-%d %H:%M:%S}")
    if kind == "date":
        last = F.lit((end - dt.timedelta(seconds=1)).date())
        return (date >= F.lit(start.date())) & (date <= last)
    return (date >= F.lit(f"{start}").cast(kind)) & (date < F.lit(f"{end}").cast(kind))


def top_movies_of_period(
    movies: DataFrame, ratings: DataFrame, as_of: dt.date | str, period: str, n: int = 10
) -> DataFrame:
    """Most rated movies of the current month or week.

    Ratings are counted per movie before they meet the movie table. Movies without categories
    take part.
    """
    counted = (
        ratings.where(in_period(F.col("date"), as_of, period, dict(ratings.dtypes)["date"]))
        .groupBy("mid")
        .agg(F.count("*").alias("rating_count"))
    )
    rated = movies.join(counted, "mid").withColumn("hot_degree", F.lit(0.0))
    board = ranking.top_n(rated, [F.desc("rating_count"), F.asc("mid")], n)
    return board.select(
        F.lit(times.as_text(as_of)).alias("date"), "rank", *ENTRY, "rating_count"
    )
