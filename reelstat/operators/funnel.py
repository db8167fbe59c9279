"""Page-to-page conversion within sessions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from reelstat.functions import pages, scores, times

# Sessions are cut into pieces of this length so that one endless session spreads over tasks.
PIECE_MS = 600_000

_STEP_KEYS = tuple(f"{a}_{b}" for a, b in pages.FUNNEL_STEPS)
_VISIT_KEYS = ("index", "detail")
KEYS = (*_VISIT_KEYS, *_STEP_KEYS)


def _totals(actions: DataFrame, tie: Sequence[str], piece_ms: int) -> DataFrame:
    """One row with the count of every funnel key.

    Steps inside a piece come from a window over (session, piece). Each piece is then reduced
    to its counts, first and last page, which gives the steps across piece borders. The
    reduction uses the partitioning of the first window, so the only other shuffle carries one
    row per piece. The number of pieces of a session is bounded by its duration.
    """
    known = (
        actions.select(
            "sessionId",
            "date",
            *tie,
            pages.page_kind(F.col("pageId")).alias("kind"),
        )
        .where(F.col("kind").isNotNull())
        .withColumn("piece", F.floor(F.col("date") / piece_ms))
    )
    order = ["date", *tie, "kind"]
    inside = known.withColumn(
        "next", F.lead("kind").over(Window.partitionBy("sessionId", "piece").orderBy(*order))
    )
    position = F.struct(*order)
    pieces = inside.groupBy("sessionId", "piece").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in _VISIT_KEYS],
        *[
            F.count_if((F.col("kind") == a) & (F.col("next") == b)).alias(f"{a}_{b}")
            for a, b in pages.FUNNEL_STEPS
        ],
        F.min_by("kind", position).alias("head"),
        F.max_by("kind", position).alias("last"),
    )
    follows = pieces.withColumn(
        "follow", F.lead("head").over(Window.partitionBy("sessionId").orderBy("piece"))
    )
    return follows.agg(
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in _VISIT_KEYS],
        *[
            (
                F.coalesce(F.sum(f"{a}_{b}"), F.lit(0))
                + F.count_if((F.col("last") == a) & (F.col("follow") == b))
            ).alias(f"{a}_{b}")
            for a, b in pages.FUNNEL_STEPS
        ],
    )


def page_transitions(
    actions: DataFrame, tie: Sequence[str] = (), piece_ms: int = PIECE_MS
) -> DataFrame:
    """Visits of index and detail pages and the counted steps, as (key, count) rows.

    ``tie`` names columns that order actions of the same millisecond.
    """
    totals = _totals(actions, tie, piece_ms)
    return totals.unpivot([], list(KEYS), "key", "count")


def page_convert_rate(
    actions: DataFrame,
    as_of: dt.date | str,
    tie: Sequence[str] = (),
    piece_ms: int = PIECE_MS,
) -> DataFrame:
    """One row of conversion rates; a rate without visits is zero."""
    totals = _totals(actions, tie, piece_ms)

    def rate(first: str, second: str):
        return scores.ratio(F.col(f"{first}_{second}"), F.col(first))

    return totals.select(
        F.lit(times.as_text(as_of)).alias("date"),
        rate("index", "detail").alias("indexToDetail"),
        rate("detail", "rating").alias("detailToRating"),
        rate("detail", "comment").alias("detailToComment"),
        rate("detail", "collect").alias("detailToCollect"),
        rate("detail", "play").alias("detailToPlay"),
    )
