"""Unique visitors per hour.

Three counts: ``exact`` on distinct (uid, ip), ``approx`` with a HyperLogLog sketch, and
``bitmap``, where each visitor sets one bit of an hourly bitmap at a hashed position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelstat.functions import hashing, times

HOUR_MS = 3_600_000


def hour_start(timestamp: Column) -> Column:
    """Start of the hour of an epoch-millisecond value."""
    return F.floor(timestamp / HOUR_MS) * HOUR_MS


def visitor_bit(uid: Column, ip: Column) -> Column:
    """Bitmap position of a visitor."""
    return hashing.bitmap_offset(F.concat(uid.cast("string"), ip))


def labelled(counts: DataFrame) -> DataFrame:
    """Replace the hour by its start and end labels."""
    start, end = times.hour_label(F.col("hour")), times.hour_label(F.col("hour") + HOUR_MS)
    return counts.select(start.alias("startTime"), end.alias("endTime"), "count")


def uv_count(events: DataFrame, method: str = "exact", rsd: float = 0.01) -> DataFrame:
    """Visitors of every hour.

    Every method combines on the map side. ``exact`` spreads an hour over (hour, uid, ip) and
    ``bitmap`` over the positions of its bitmap: a task sends a position once, so rows that do
    not arrive in time order cost no sparse bitmap blocks.
    """
    hourly = events.select(hour_start(F.col("timestamp")).alias("hour"), "uid", "ip")
    if method == "exact":
        counts = hourly.distinct().groupBy("hour").agg(F.count("*").alias("count"))
    elif method == "approx":
        sketch = F.approx_count_distinct(F.struct("uid", "ip"), rsd)
        counts = hourly.groupBy("hour").agg(sketch.alias("count"))
    elif method == "bitmap":
        bits = hourly.select("hour", visitor_bit(F.col("uid"), F.col("ip")).alias("bit"))
        counts = bits.distinct().groupBy("hour").agg(F.count("*").alias("count"))
    else:
        raise ValueError(f"unknown method: {method!r}")
    return labelled(counts)
