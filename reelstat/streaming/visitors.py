"""Running and closed visitor counts of an event stream, exact or by bitmaps, judged late once and for all.

Each micro-batch is split by :func:`reelstat.streaming.late.split_late`, which alone decides what comes too late. What the
rest adds is merged into small tables: one row for each hour, replaced when its count changes, and a log of the counts that
were reported. An hour is reported when it closes, and again for every batch that still adds to it while late rows are
allowed. Only visitors, or bitmaps, of the hours that may still change are kept beside that.

A batch that runs again writes the same rows to the same places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from reelstat.operators.visitors import HOUR_MS, hour_start, labelled, visitor_bit
from reelstat.session import saved
from reelstat.sinks.tables import write_batch
from reelstat.streaming.late import DAY_MS, DELAY_MS, LATENESS_MS, split_late
from reelstat.streaming.progress import Progress, larger
from reelstat.streaming.run import to_batches

SEEN = "hour long, uid long, ip string, batch_id int"
COUNTS = "hour long, count long, day long"
BLOCKS = "hour long, block long, bits binary, day long"
REPORTS = "hour long, count long, correction boolean, batch_id int"


def _day(hour: Column) -> Column:
    return F.floor(hour / DAY_MS).cast("long")


def _replace(spark: SparkSession, fresh: DataFrame, path: str, schema: str, merge) -> None:
    """Bring saved rows into a table laid out by day: ``merge`` of known and fresh rows, of the touched days only."""
    days = [row[0] for row in fresh.select(_day(F.col("hour"))).distinct().collect()]
    columns = [c for c in spark.createDataFrame([], schema).columns if c != "day"]
    # An empty write makes sure that the table can be read.
    fresh.limit(0).select(*columns, _day(F.col("hour")).alias("day")).write.mode("append").partitionBy("day").parquet(path)
    if not days:
        return
    known = spark.read.schema(schema).parquet(path).where(F.col("day").isin(days)).select(*columns)
    merged = saved(merge(known, fresh.select(*columns)).withColumn("day", _day(F.col("hour"))))
    writer = merged.repartition("day").sortWithinPartitions("day", "hour").write.mode("overwrite").partitionBy("day")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _newer(known: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row an hour: the fresh one, if there is one."""
    return known.join(fresh, "hour", "left_anti").unionByName(fresh)


def _ored(known: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row for each hour and block, with the bits of both."""
    return known.unionByName(fresh).groupBy("hour", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _ended(newest: int | None, delay_ms: int) -> int | None:
    """End of the last hour that is over once ``newest`` has been seen."""
    return None if newest is None else (newest - delay_ms) // HOUR_MS * HOUR_MS


def _ends_by(until: int | None) -> Column:
    return F.lit(False) if until is None else F.col("hour") + HOUR_MS <= until


def _report(
    spark: SparkSession, counts: DataFrame, touched: DataFrame, before: int | None, now: int | None
) -> DataFrame:
    """The counts of the hours that end between two times, and of touched hours that had ended before."""
    closing = counts.where(_ends_by(now) & ~_ends_by(before)).withColumn("correction", F.lit(False))
    first, last = (None if t is None else t // DAY_MS for t in (before, now))
    # Conditions on the day leave the folders of all other days out.
    if first is not None:
        closing = closing.where(F.col("day") >= first - 1)
    if last is not None:
        closing = closing.where(F.col("day") <= last)
    again = touched.where(_ends_by(before))
    days = [row[0] for row in again.select(_day(F.col("hour"))).distinct().collect()]
    changed = counts.where(F.col("day").isin(days) if days else F.lit(False)).join(again.select("hour"), "hour", "left_semi")
    columns = ["hour", "count", "correction"]
    return closing.select(*columns).unionByName(changed.withColumn("correction", F.lit(True)).select(*columns))


def _start(events: DataFrame, folder: str, checkpoint: str, delay_ms: int, lateness_ms: int, interval: str | None, merge):
    """Run ``merge`` on the on-time rows of every batch: it gives the touched hours and the table of counts by day."""
    spark = events.sparkSession
    seen, rounds = Progress(spark, f"{folder}/state/newest"), Progress(spark, f"{folder}/state/rounds")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before, turn = seen.before(batch_id), rounds.before(batch_id) or 0
            newest = larger(before, batch.agg(F.max("timestamp")).first()[0])
            on_time, late = split_late(batch, before, delay_ms, lateness_ms)
            write_batch(late, batch_id, f"{folder}/late")
            hourly = on_time.withColumn("hour", hour_start(F.col("timestamp")))
            # Hours up to here take no more rows.
            final, was_final = (None if t is None else t - delay_ms - lateness_ms for t in (newest, before))
            over = final is not None and (was_final is None or final // HOUR_MS != was_final // HOUR_MS)
            touched, counts = merge(hourly, batch_id, turn, final if over else None)
            report = _report(spark, counts, touched, _ended(before, delay_ms), _ended(newest, delay_ms))
            write_batch(report, batch_id, f"{folder}/reports")
            seen.after(batch_id, newest)
            rounds.after(batch_id, turn + over)
        finally:
            batch.unpersist()

    return to_batches(events, write, checkpoint, interval=interval)


def start_visitor_counts(
    events: DataFrame,
    folder: str,
    checkpoint: str,
    delay_ms: int = DELAY_MS,
    lateness_ms: int = LATENESS_MS,
    interval: str | None = None,
) -> StreamingQuery:
    """Count the different visitors of every hour of (uid, ip, timestamp) rows while they come.

    ``running`` holds a row for each hour with its current count, ``reports`` what was reported of closed hours, ``late`` the
    rows that came too late. A row counts if no earlier one has its hour, user and address; those of open hours lie
    in one of two folders of ``seen``, and what is still open moves to the other one when hours are over.
    """
    spark = events.sparkSession

    def merge(hourly: DataFrame, batch_id: int, turn: int, final: int | None) -> tuple[DataFrame, DataFrame]:
        place = f"{folder}/seen/turn={turn % 2}"
        visits = hourly.select("hour", "uid", "ip").distinct()
        # An empty write makes sure that the table can be read.
        write_batch(visits.limit(0), batch_id, place)
        known = spark.read.schema(SEEN).parquet(place).where(F.col("batch_id") != batch_id).drop("batch_id")
        # Visitors may have no user or address, which equal each other here.
        same = [visits[c].eqNullSafe(known[c]) for c in ("hour", "uid", "ip")]
        fresh = saved(visits.join(known, same[0] & same[1] & same[2], "left_anti"))
        write_batch(fresh, batch_id, place, cluster_by=("hour", "uid", "ip"))
        touched = saved(fresh.select("hour").distinct())
        added = known.join(touched, "hour", "left_semi").unionByName(fresh)
        counted = saved(added.groupBy("hour").agg(F.count("*").alias("count")))
        _replace(spark, counted, f"{folder}/running", COUNTS, _newer)
        if final is not None:
            kept = spark.read.schema(SEEN).parquet(place).where(~_ends_by(final)).drop("batch_id")
            other = kept.sortWithinPartitions("hour").withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            other.option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(
                f"{folder}/seen/turn={(turn + 1) % 2}"
            )
        return touched, spark.read.schema(COUNTS).parquet(f"{folder}/running")

    return _start(events, folder, checkpoint, delay_ms, lateness_ms, interval, merge)


def start_visitor_bitmaps(
    events: DataFrame,
    folder: str,
    checkpoint: str,
    delay_ms: int = DELAY_MS,
    lateness_ms: int = LATENESS_MS,
    interval: str | None = None,
) -> StreamingQuery:
    """The same by a bitmap for each hour, in blocks: ``blocks`` holds the bits of open hours, one row for each hour and block.

    A batch's blocks are joined with the stored ones by OR. When an hour is over, its blocks go and its count stays.
    """
    spark = events.sparkSession

    def merge(hourly: DataFrame, batch_id: int, turn: int, final: int | None) -> tuple[DataFrame, DataFrame]:
        bits = hourly.select("hour", visitor_bit(F.col("uid"), F.col("ip")).alias("bit"))
        blocks = bits.groupBy("hour", F.bitmap_bucket_number("bit").alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
        )
        fresh = saved(blocks)
        _replace(spark, fresh, f"{folder}/blocks", BLOCKS, _ored)
        touched = saved(fresh.select("hour").distinct())
        stored = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
        days = [row[0] for row in touched.select(_day(F.col("hour"))).distinct().collect()]
        mine = stored.where(F.col("day").isin(days) if days else F.lit(False)).join(touched, "hour", "left_semi")
        counted = saved(mine.groupBy("hour").agg(F.sum(F.bitmap_count("bits")).alias("count")))
        _replace(spark, counted, f"{folder}/running", COUNTS, _newer)
        if final is not None:
            # Days with hours that are over are written anew without these; the days that end so go whole.
            over = [row[0] for row in stored.where(_ends_by(final)).select("day").distinct().collect()]
            kept = saved(stored.where(F.col("day").isin(over) if over else F.lit(False)).where(~_ends_by(final)))
            writer = kept.repartition("day").write.mode("overwrite").partitionBy("day")
            writer.option("partitionOverwriteMode", "dynamic").parquet(f"{folder}/blocks")
            left = {row[0] for row in kept.select("day").distinct().collect()}
            _forget_days(spark, f"{folder}/blocks", [day for day in over if day not in left])
        return touched, spark.read.schema(COUNTS).parquet(f"{folder}/running")

    return _start(events, folder, checkpoint, delay_ms, lateness_ms, interval, merge)


def _forget_days(spark: SparkSession, path: str, days: list[int]) -> None:
    for day in days:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/day={day}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def running_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The current count of every hour that has a visitor."""
    return labelled(spark.read.schema(COUNTS).parquet(f"{folder}/running").select("hour", "count"))


def reported_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What was last reported of every closed hour."""
    reports = spark.read.schema(REPORTS).parquet(f"{folder}/reports")
    return labelled(reports.groupBy("hour").agg(F.max_by("count", "batch_id").alias("count")))
