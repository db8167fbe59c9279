"""Most watched movies in sliding windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reelstat.functions import ranking

SIZE_MS = 3_600_000
SLIDE_MS = 300_000


def watch_steps(events: DataFrame, slide_ms: int = SLIDE_MS) -> DataFrame:
    """Distinct slide steps in which a user watched a movie, spread over (mid, uid, step)."""
    return (
        events.where((F.col("event") == "play") & F.col("mid").isNotNull())
        .select("mid", "uid", F.floor(F.col("timestamp") / slide_ms).alias("step"))
        .distinct()
    )


def step_viewers(
    steps: DataFrame, size_ms: int = SIZE_MS, slide_ms: int = SLIDE_MS
) -> DataFrame:
    """Distinct viewers of every movie in every sliding window, as (mid, windowEnd, count).

    Steps are never copied into the windows that cover them. The windows in which a step is the
    user's first one form a range: it starts after the previous step of the same user, or where
    the step first comes into reach. Only the two borders of each range travel on, as +1 and -1,
    combined on the map side. A running sum per movie over its borders, whose number is bounded
    by the calendar, gives the count of each window.
    """
    if size_ms % slide_ms:
        raise ValueError("the window size must be a multiple of the slide")
    reach = size_ms // slide_ms - 1
    of_user = Window.partitionBy("mid", "uid").orderBy("step")
    ranges = steps.select(
        "mid",
        F.greatest(F.col("step") - reach, F.lag("step").over(of_user) + 1).alias("opens"),
        (F.col("step") + 1).alias("closes"),
    )
    borders = F.array(
        F.struct(F.col("opens").alias("first"), F.lit(1).alias("change")),
        F.struct(F.col("closes").alias("first"), F.lit(-1).alias("change")),
    )
    changes = (
        ranges.select("mid", F.inline(borders))
        .groupBy("mid", "first")
        .agg(F.sum("change").alias("change"))
    )
    by_movie = Window.partitionBy("mid").orderBy("first")
    running = changes.select(
        "mid",
        "first",
        F.sum("change").over(by_movie).alias("count"),
        F.lead("first").over(by_movie).alias("until"),
    ).where(F.col("count") > 0)
    starts = running.select(
        "mid", "count", F.explode(F.sequence("first", F.col("until") - 1)).alias("start")
    )
    return starts.select(
        "mid", (F.col("start") * slide_ms + size_ms).alias("windowEnd"), "count"
    )


def window_viewers(
    events: DataFrame, size_ms: int = SIZE_MS, slide_ms: int = SLIDE_MS
) -> DataFrame:
    """:func:`step_viewers` of raw events."""
    return step_viewers(watch_steps(events, slide_ms), size_ms, slide_ms)


def rank_windows(viewers: DataFrame, size_ms: int = SIZE_MS, n: int = 10) -> DataFrame:
    """The ``n`` movies of every window with the most viewers."""
    best = ranking.top_n_per_group(viewers, ["windowEnd"], [F.desc("count"), F.asc("mid")], n)
    return best.select(
        (F.col("windowEnd") - size_ms).alias("windowStart"), "windowEnd", "mid", "count", "rank"
    )


def hot_movies_window(
    events: DataFrame, size_ms: int = SIZE_MS, slide_ms: int = SLIDE_MS, n: int = 10
) -> DataFrame:
    """The ``n`` movies of every window with the most distinct viewers."""
    return rank_windows(window_viewers(events, size_ms, slide_ms), size_ms, n)
