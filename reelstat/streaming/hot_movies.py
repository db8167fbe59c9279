"""Most watched movies of an event stream in sliding windows.

Every window is ranked once, when the newest play of the stream has passed its end by the allowed delay, whether or not
a later play falls near it. Plays are reduced to distinct (movie, user, slide step) rows and kept as long as a window
that is still open covers them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from reelstat.operators.hot_movies import SIZE_MS, SLIDE_MS, rank_windows, step_viewers, watch_steps
from reelstat.sinks.tables import write_batch
from reelstat.streaming.progress import Progress, larger
from reelstat.streaming.run import to_batches

DELAY_MS = 30_000


def closed_until(newest: int | None, delay_ms: int = DELAY_MS, slide_ms: int = SLIDE_MS) -> int | None:
    """End of the last window that is closed once ``newest`` has been seen."""
    return None if newest is None else (newest - delay_ms) // slide_ms * slide_ms


def newly_closed(
    steps: DataFrame,
    done: int | None,
    closed: int,
    size_ms: int = SIZE_MS,
    slide_ms: int = SLIDE_MS,
    n: int = 10,
) -> DataFrame:
    """Rankings of the windows that end after ``done`` and not after ``closed``."""
    wanted = F.col("windowEnd") <= closed
    if done is not None:
        wanted &= F.col("windowEnd") > done
    viewers = step_viewers(steps.select("mid", "uid", "step").distinct(), size_ms, slide_ms)
    return rank_windows(viewers.where(wanted), size_ms, n)


def start_hot_movies(
    events: DataFrame,
    path: str,
    steps_path: str,
    state_path: str,
    checkpoint: str,
    size_ms: int = SIZE_MS,
    slide_ms: int = SLIDE_MS,
    n: int = 10,
    delay_ms: int = DELAY_MS,
    interval: str | None = None,
) -> StreamingQuery:
    """Write the ranking of every window of (uid, mid, event, timestamp) rows once it is closed.

    A play counts in those of its windows that are still open when it comes. The steps that open windows need lie in one
    of two folders of ``steps_path``. When windows close, what later ones need is carried to the other folder,
    which replaces what it held, so storage stays within the plays of one window.
    """
    spark = events.sparkSession
    seen, rounds = Progress(spark, f"{state_path}/newest"), Progress(spark, f"{state_path}/rounds")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before, turn = seen.before(batch_id), rounds.before(batch_id) or 0
            plays = batch.where((F.col("event") == "play") & F.col("mid").isNotNull())
            newest = larger(before, plays.agg(F.max("timestamp")).first()[0])
            done, closed = closed_until(before, delay_ms, slide_ms), closed_until(newest, delay_ms, slide_ms)
            held = f"{steps_path}/turn={turn % 2}"
            write_batch(watch_steps(plays, slide_ms), batch_id, held)
            if closed is not None and closed != done:
                stored = spark.read.schema("mid long, uid long, step long").parquet(held)
                write_batch(newly_closed(stored, done, closed, size_ms, slide_ms, n), batch_id, path)
                # The next window to close starts one slide later.
                kept = stored.where((F.col("step") + 1) * slide_ms > closed + slide_ms - size_ms).distinct()
                other = kept.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                other.option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(
                    f"{steps_path}/turn={(turn + 1) % 2}"
                )
                turn += 1
            seen.after(batch_id, newest)
            rounds.after(batch_id, turn)
        finally:
            batch.unpersist()

    return to_batches(events, write, checkpoint, interval=interval)
