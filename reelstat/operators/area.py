"""Top movies per city."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from reelstat.functions import ranking, text, times

MOVIE_IDS = ("clickMovieId", "collectMovieId", "ratingMovieId", "commentMovieId")


def city_movie_viewers(actions: DataFrame) -> DataFrame:
    """Distinct users per city and movie.

    Duplicates go first, spread over (city, movie, user); what remains is counted with
    map-side combining, so neither a crowded city nor a hit movie gathers in one task.
    """
    seen = actions.select("userId", text.first_positive(*MOVIE_IDS).alias("movieId"), "cityId")
    return (
        seen.where(F.col("movieId").isNotNull())
        .distinct()
        .groupBy("cityId", "movieId")
        .agg(F.count("*").alias("count"))
    )


def top_movies_of_area(
    actions: DataFrame, cities: DataFrame, movies: DataFrame, as_of: dt.date | str, n: int = 10
) -> DataFrame:
    """The ``n`` movies of each city with the most distinct users, with names."""
    best = ranking.top_n_per_group(
        city_movie_viewers(actions), ["cityId"], [F.desc("count"), F.asc("movieId")], n
    )
    return (
        best.join(cities.select(F.col("id").alias("cityId"), F.col("name").alias("cityName")), "cityId")
        .join(
            movies.select(F.col("mid").alias("movieId"), F.col("movie_name").alias("movieName")),
            "movieId",
        )
        .select(
            F.lit(times.as_text(as_of)).alias("date"),
            "cityId",
            "cityName",
            "movieId",
            "movieName",
            "count",
            "rank",
        )
    )
