"""Score arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Weights of ratings, comments, collections and plays, and the decay exponent.
HOT_WEIGHTS = (0.5, 0.1, 0.2, 1.0)
HOT_GRAVITY = 1.8


def hot_degree(
    ratings: Column,
    comments: Column,
    collections: Column,
    plays: Column,
    hours: Column,
    weights: Sequence[float] = HOT_WEIGHTS,
    gravity: float = HOT_GRAVITY,
) -> Column:
    """Popularity: weighted counts, where plays fade with the age of the movie."""
    w_rating, w_comment, w_collection, w_play = weights
    steady = (ratings - 1) * w_rating + comments * w_comment + collections * w_collection
    return steady + plays * w_play / F.pow(hours + 2, F.lit(float(gravity)))


def log10_count(count: Column) -> Column:
    """log10 of a count where an empty count weighs like one."""
    return F.log10(F.greatest(count, F.lit(1)).cast("double"))


def ratio(part: Column, whole: Column) -> Column:
    """Quotient that is zero when the whole is zero or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
