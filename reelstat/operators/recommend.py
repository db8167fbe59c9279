"""Recommendations after a rating: similar unrated movies, scored by the user's recent ratings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from reelstat.functions import ranking, scores, times
from reelstat.operators import neighbour_index
from reelstat.operators.similarity import DECIMALS
from reelstat.session import broadcast_if_small, saved

# Candidate lists are joined in slices of this many places.
SLICE = 64

INFO = ("movie_name", "hot_degree", "img_urls", "rating_num", "categories")


def recent_ratings(history: DataFrame, recent: int, tie: Sequence[str]) -> DataFrame:
    """The ``recent`` ratings of each user before the newest one, as (uid, seen, rating)."""
    order = [F.desc("date"), *[F.desc(c) for c in tie]]
    newest = ranking.top_n_per_group(history, ["uid"], order, recent + 1, rank="place")
    return newest.where(F.col("place") > 1).select("uid", F.col("mid").alias("seen"), "rating")


def candidates(requests: DataFrame, rated: DataFrame, index: str, n: int) -> DataFrame:
    """The ``n`` nearest movies of each rated movie that its user has not rated, from a stored index of vectors.

    A user who rated r movies finds them within the first n + r places of the similarity list, so a list is computed
    just as deep as the users that ask for it need, and is joined in slices. This is exact, and a popular movie is
    spread over the slices of its list.
    """
    counts = rated.groupBy("uid").agg(F.count("*").alias("known"))
    deep = requests.join(counts, "uid", "left").withColumn("depth", n + F.coalesce("known", F.lit(0)))
    asked = saved(deep.groupBy("mid").agg(F.max("depth").alias("depth")))
    lists = neighbour_index.search(requests.sparkSession, index, asked)
    lists = lists.withColumn("slice", F.floor((F.col("place") - 1) / SLICE))
    slices = F.sequence(F.lit(0).cast("long"), F.floor((F.col("depth") - 1) / SLICE))
    asks = deep.select("uid", "mid", "depth", F.explode(slices).alias("slice"))
    near = (
        asks.join(lists, ["mid", "slice"])
        .where(F.col("place") <= F.col("depth"))
        .select("uid", "mid", "mid2", "score")
    )
    fresh = near.join(rated.withColumnRenamed("mid", "mid2"), ["uid", "mid2"], "left_anti")
    order = [F.desc("score"), F.asc("mid2")]
    best = ranking.top_n_per_group(fresh, ["uid", "mid"], order, n)
    return best.select("uid", "mid", F.col("mid2").alias("candidate"))


def _likenesses(hi: float):
    """From requests (uid, mid, near, recent) to what each candidate's score is made of.

    ``near`` and ``recent`` are lists of structs with a unit vector. A recent movie without a direction is like nothing;
    recent movies that point away from the candidate do not count.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(4)]
            requests: list[int] = []
            for near, seen in zip(batch.column(2), batch.column(3)):
                near, seen = near.values, seen.values
                width = len(near.field("unit")[0])
                mine = near.field("unit").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                known = seen.field("unit").is_valid().to_numpy(zero_copy_only=False)
                theirs = np.zeros((len(seen), width))
                directed = seen.field("unit").filter(pa.array(known)).flatten().to_numpy(zero_copy_only=False)
                theirs[known] = directed.reshape(-1, width)
                likeness = np.round(mine @ theirs.T, DECIMALS)
                counts = likeness >= 0
                rating = seen.field("rating").to_numpy(zero_copy_only=False)
                parts = (
                    near.field("candidate").to_numpy(),
                    np.where(counts, likeness * rating, 0.0).sum(axis=1),
                    counts.sum(axis=1),
                    (counts & (rating > hi)).sum(axis=1),
                )
                for list_, part in zip(out, parts):
                    list_.append(part)
                requests.append(len(mine))
            if requests:
                at = pa.array(np.repeat(np.arange(len(requests)), requests))
                columns = [batch.column(0).take(at), batch.column(1).take(at), *[pa.array(np.concatenate(c)) for c in out]]
                yield pa.RecordBatch.from_arrays(columns, names=["uid", "mid", "candidate", "total", "n", "high"])

    return compare


def _compared(picked: DataFrame, latest: DataFrame, unit: DataFrame, hi: float) -> DataFrame:
    """(uid, mid, candidate, total, n, high) of every candidate: the sum of likeness by rating over the recent movies that
    count, how many these are, and how many of them are rated above ``hi``.

    A request has a bounded number of candidates and a user a bounded number of recent movies, so both fit a row.
    """
    # Dealt by user at once, so that the vectors are shuffled once for both the request and the user's recent movies.
    mine = picked.join(unit.withColumnRenamed("mid", "candidate"), "candidate").repartition("uid")
    near = mine.groupBy("uid", "mid").agg(F.collect_list(F.struct("candidate", "unit")).alias("near"))
    seen = latest.join(unit.withColumnRenamed("mid", "seen"), "seen", "left")
    recent = seen.groupBy("uid").agg(F.collect_list(F.struct(F.col("rating").cast("double").alias("rating"), "unit")).alias("recent"))
    both = near.join(recent, "uid").select("uid", "mid", "near", "recent")
    return both.mapInArrow(_likenesses(hi), "uid long, mid long, candidate long, total double, n long, high long")


def _units(events: DataFrame, index: str) -> DataFrame:
    """The unit vectors of an index. One of zeros has no direction, stands in no index and is like nothing."""
    return events.sparkSession.read.schema(neighbour_index.MEMBER).parquet(f"{index}/members").select("mid", "unit")


def with_candidates(events: DataFrame, index: str) -> DataFrame:
    """The events (uid, mid, ...) of movies that stand in the index.

    Any other movie is like nothing, so it has no candidates, and the histories of its users need not be looked at for it.
    """
    return events.join(_units(events, index).select("mid"), "mid", "left_semi")


def realtime_recommend(
    events: DataFrame,
    ratings: DataFrame,
    index: str,
    movies: DataFrame,
    as_of: dt.date | str,
    n: int = 30,
    recent: int = 10,
    hi: float = 60.0,
    penalty_sign: int = -1,
    tie: Sequence[str] = ("mid",),
) -> DataFrame:
    """Ranked recommendations for every rating event (uid, mid).

    ``index`` is the folder of a stored :mod:`neighbour_index` of the movies' vectors: similarities are computed for the asked
    movies only, and no table of pairs is kept. ``tie`` orders ratings of the same date. Equal events are computed once and
    reported as often as they came. The events and the ratings of their users are used several times, so they are saved
    once instead of reading the whole rating table again.
    """
    unit = _units(events, index)
    counted = events.groupBy("uid", "mid").agg(F.count("*").alias("copies"))
    requests = saved(with_candidates(counted, index).select("uid", "mid", "copies"))
    users = broadcast_if_small(requests).select("uid")
    history = ratings.join(users, "uid", "left_semi").select("uid", "mid", "rating", "date", *_extra(tie))
    # Spread over (uid, mid), as the distinct and the anti join need it; a busy user stays spread.
    history = saved(history.repartition("uid", "mid"))
    latest = recent_ratings(history, recent, tie)
    rated = history.select("uid", "mid").distinct()

    picked = candidates(requests, rated, index, n)
    compared = _compared(picked, latest, unit, hi).where("n > 0")
    level = (
        F.col("total") / F.col("n")
        + scores.log10_count(F.col("high"))
        + penalty_sign * scores.log10_count(F.col("n") - F.col("high"))
    )
    levels = compared.select("uid", "mid", "candidate", F.round(level, DECIMALS).alias("level"))
    shown = movies.where(F.col("off_shelf") == 0).select(
        F.col("mid").alias("candidate"), "movie_name", F.lit(0.0).alias("hot_degree"),
        "img_urls", "rating_num", "categories",
    )
    order = Window.partitionBy("uid", "mid").orderBy(F.desc("level"), F.asc("candidate"))
    listed = levels.join(shown, "candidate").withColumn("rank", F.row_number().over(order))
    return (
        listed.join(requests, ["uid", "mid"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(
            F.lit(times.as_text(as_of)).alias("date"),
            "uid",
            F.col("mid").alias("rated_mid"),
            "copy",
            "rank",
            F.col("candidate").alias("mid"),
            *INFO,
            F.col("level").alias("score"),
        )
    )


def _extra(tie: Sequence[str]) -> list[str]:
    return [c for c in tie if c not in ("uid", "mid", "rating", "date")]


def as_document(recommended: DataFrame) -> DataFrame:
    """One row per rating event with its recommendations as a list of at most ``n`` movies."""
    return ranking.nest(
        recommended,
        ["date", "uid", "rated_mid", "copy"],
        ["mid", *INFO, "score"],
        "userResc",
    )
