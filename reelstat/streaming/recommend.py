"""Recommendations for a stream of ratings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from reelstat.operators.recommend import realtime_recommend, with_candidates
from reelstat.sinks.tables import write_batch
from reelstat.sources.rating_store import RatingStore
from reelstat.streaming.run import to_batches

INTERVAL = "2 seconds"

Reader = Callable[[], DataFrame]


def start_recommendations(
    events: DataFrame,
    ratings: RatingStore,
    index: str,
    movies: Reader,
    path: str,
    checkpoint: str,
    as_of: dt.date | str | None = None,
    interval: str | None = INTERVAL,
    keep: bool = False,
    **options,
) -> StreamingQuery:
    """Write the recommendations of every micro-batch of rating events (uid, mid).

    Of the stored ratings the parts of the batch's users are read, anew for each batch, so ratings that arrived meanwhile
    count. ``index`` is the folder of a stored index of the movies' vectors. With ``keep`` the events, which then need the
    columns of the store, are added to it before they are answered. Without ``as_of`` rows carry the day on which their
    batch runs.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        day = as_of or dt.date.today()
        if keep:
            ratings.append(batch, batch_id)
        known = ratings.of_users(with_candidates(batch, index))
        found = realtime_recommend(batch, known, index, movies(), day, **options)
        write_batch(found, batch_id, path)

    return to_batches(events, write, checkpoint, interval=interval)
