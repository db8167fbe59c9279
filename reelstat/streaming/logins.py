"""Repeated login failures in an event stream, and the lock table they feed.

Events wait until the newest event has passed them by the allowed delay; then the batch operator compares the events of a
user in time order. Only the events that an open pair can need are kept from batch to batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from reelstat.operators.logins import LOCK_MINUTES, WITHIN_MS, current_locks, failure_pairs, warning_columns
from reelstat.session import saved
from reelstat.sinks.tables import write_batch
from reelstat.streaming.progress import Progress, larger
from reelstat.streaming.run import to_batches

DELAY_MS = 0
# Parts of the lock table; a batch rewrites those of its users only.
LOCK_PARTS = 64


def start_login_fails(
    logins: DataFrame,
    path: str,
    late_path: str,
    events_path: str,
    state_path: str,
    checkpoint: str,
    within_ms: int = WITHIN_MS,
    lock_minutes: int = LOCK_MINUTES,
    tie: Sequence[str] = (),
    delay_ms: int = DELAY_MS,
    interval: str | None = None,
) -> StreamingQuery:
    """Write warnings for a stream of (uid, eventType, timestamp, ties), each once its second event is complete.

    An event that comes after the stream has passed its time goes to ``late_path`` and takes no part. What later pairs
    may need lies in one of two folders of ``events_path``, so storage stays within the open stretch of time.
    """
    spark = logins.sparkSession
    seen, rounds = Progress(spark, f"{state_path}/newest"), Progress(spark, f"{state_path}/rounds")
    columns = ("uid", "eventType", "timestamp", *tie)
    schema = logins.select(*columns).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before, turn = seen.before(batch_id), rounds.before(batch_id) or 0
            newest = larger(before, batch.agg(F.max("timestamp")).first()[0])
            done = None if before is None else before - delay_ms
            complete = None if newest is None else newest - delay_ms
            late = F.lit(False) if done is None else F.col("timestamp") <= done
            held = f"{events_path}/turn={turn % 2}"
            write_batch(batch.where(late).select(*columns), batch_id, late_path)
            write_batch(batch.where(~late).select(*columns), batch_id, held)
            if complete is not None and complete != done:
                stored = spark.read.schema(schema).parquet(held)
                pairs = failure_pairs(stored.where(F.col("timestamp") <= complete), within_ms, tie)
                if done is not None:
                    pairs = pairs.where(F.col("next_time") > done)
                write_batch(pairs.select(*warning_columns(lock_minutes)), batch_id, path)
                kept = stored.where(F.col("timestamp") > complete - within_ms)
                other = kept.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                other.option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(
                    f"{events_path}/turn={(turn + 1) % 2}"
                )
                turn += 1
            seen.after(batch_id, newest)
            rounds.after(batch_id, turn)
        finally:
            batch.unpersist()

    return to_batches(logins, write, checkpoint, interval=interval)


def merge_locks(warnings: DataFrame, path: str, parts: int = LOCK_PARTS) -> None:
    """Bring the latest lock of every warned user into a table of one row per user.

    The table is partitioned by a hash of the user, and only partitions of users with a warning are read and written.
    A repeated batch changes nothing, since the later lock wins.
    """
    spark = warnings.sparkSession
    part = F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int")
    fresh = saved(current_locks(warnings).withColumn("part", part))
    touched = [row["part"] for row in fresh.select("part").distinct().collect()]
    if not touched:
        return
    # An empty write makes sure that the table can be read.
    fresh.limit(0).write.mode("append").partitionBy("part").parquet(path)
    known = spark.read.schema("uid long, no_login_time long, part int").parquet(path)
    merged = fresh.unionByName(known.where(F.col("part").isin(touched)))
    current = saved(current_locks(merged).withColumn("part", part))
    writer = current.repartition("part").write.mode("overwrite").partitionBy("part")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def start_lock_table(
    warnings: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep the lock table up to date from a stream of warnings."""
    return to_batches(warnings, lambda batch, number: merge_locks(batch, path), checkpoint, interval=interval)
