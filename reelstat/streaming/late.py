"""Split a stream into rows that are on time for their hour and rows that come too late.

The engine's own late-row filter drops rows silently and lags one micro-batch behind, so the
decision is made here: a row is late when its hour had already closed, allowance included,
for the newest event of all earlier micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from reelstat.operators.visitors import HOUR_MS, hour_start, uv_count
from reelstat.sinks.tables import write_batch
from reelstat.streaming.progress import Progress, larger
from reelstat.streaming.run import to_batches

DELAY_MS = 60_000
LATENESS_MS = 60_000
DAY_MS = 24 * HOUR_MS


def split_late(
    rows: DataFrame,
    newest: int | None,
    delay_ms: int = DELAY_MS,
    lateness_ms: int = LATENESS_MS,
    size_ms: int = HOUR_MS,
) -> tuple[DataFrame, DataFrame]:
    """On-time and late rows, given the newest event time before this batch."""
    if newest is None:
        return rows, rows.where(F.lit(False))
    closed = hour_start(F.col("timestamp")) + size_ms <= newest - delay_ms - lateness_ms
    return rows.where(~closed), rows.where(closed)


def recount(
    on_time: DataFrame, since: int | None = None, until: int | None = None, method: str = "exact"
) -> DataFrame:
    """Visitors of the hours that start in a range, from the stored on-time rows.

    The range chooses folders by day, and row groups by hour within them.
    """
    chosen = on_time
    if since is not None:
        chosen = chosen.where((F.col("day") >= since // DAY_MS) & (F.col("hour") >= since))
    if until is not None:
        chosen = chosen.where((F.col("day") <= until // DAY_MS) & (F.col("hour") < until))
    return uv_count(chosen.drop("hour", "day"), method)


def start_late_split(
    events: DataFrame,
    on_time_path: str,
    late_path: str,
    state_path: str,
    checkpoint: str,
    delay_ms: int = DELAY_MS,
    lateness_ms: int = LATENESS_MS,
    interval: str | None = None,
) -> StreamingQuery:
    """Write on-time and late rows of every micro-batch to two tables.

    On-time rows are laid out by ``day`` in the order of ``hour``, so :func:`recount` reads little more than the hours it needs.
    """
    seen = Progress(events.sparkSession, state_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before = seen.before(batch_id)
            on_time, late = split_late(batch, before, delay_ms, lateness_ms)
            hourly = on_time.withColumn("hour", hour_start(F.col("timestamp")))
            daily = hourly.withColumn("day", F.floor(F.col("hour") / DAY_MS).cast("long"))
            write_batch(daily, batch_id, on_time_path, ("day",), ("hour", "uid", "ip"))
            write_batch(late, batch_id, late_path)
            newest = batch.agg(F.max("timestamp")).first()[0]
            seen.after(batch_id, larger(before, newest))
        finally:
            batch.unpersist()

    return to_batches(events, write, checkpoint, interval=interval)
