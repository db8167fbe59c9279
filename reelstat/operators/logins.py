"""Repeated login failures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Longest gap between two failures, and the length of the lock.
WITHIN_MS = 2_000
LOCK_MINUTES = 30
WARNING = "repeated login failures within a short time, possible malicious login"


def warning_columns(lock_minutes: int = LOCK_MINUTES) -> list[Column]:
    """Warning fields from a matched first failure (uid, timestamp)."""
    return [
        F.col("uid"),
        F.col("timestamp").cast("string").alias("time"),
        F.lit(WARNING).alias("message"),
        (F.col("timestamp") + lock_minutes * 60_000).alias("no_login_time"),
    ]


def failure_pairs(
    logins: DataFrame,
    within_ms: int = WITHIN_MS,
    tie: Sequence[str] = (),
    piece_ms: int = 600_000,
) -> DataFrame:
    """Every failure whose very next event of the same user fails in time: uid, timestamp and next_time.

    Events of one millisecond follow ``tie`` and then their kind, a failure before a success. The events of a user are
    cut into time pieces, so an account under attack spreads over tasks. A piece also receives the first
    ``within_ms`` of the next one: a later event cannot complete a match, so this one shuffle sees everything it needs.
    """
    span = max(piece_ms, within_ms)
    piece = F.floor(F.col("timestamp") / span)
    early = F.col("timestamp") - piece * span < within_ms
    homes = F.when(early, F.array(piece, piece - 1)).otherwise(F.array(piece))
    spread = logins.select("uid", "eventType", "timestamp", *tie).withColumn(
        "home", F.explode(homes)
    )
    order = Window.partitionBy("uid", "home").orderBy("timestamp", *tie, "eventType")
    following = spread.select(
        "uid",
        "timestamp",
        "eventType",
        (F.col("home") == piece).alias("own"),
        F.lead("eventType").over(order).alias("next_type"),
        F.lead("timestamp").over(order).alias("next_time"),
    )
    matched = following.where(
        F.col("own")
        & (F.col("eventType") == "fail")
        & (F.col("next_type") == "fail")
        & (F.col("next_time") - F.col("timestamp") < within_ms)
    )
    return matched.select("uid", "timestamp", "next_time")


def login_fail_detect(
    logins: DataFrame,
    within_ms: int = WITHIN_MS,
    lock_minutes: int = LOCK_MINUTES,
    tie: Sequence[str] = (),
    piece_ms: int = 600_000,
) -> DataFrame:
    """A warning for every pair of :func:`failure_pairs`."""
    return failure_pairs(logins, within_ms, tie, piece_ms).select(*warning_columns(lock_minutes))


def current_locks(warnings: DataFrame) -> DataFrame:
    """Latest lock of every user."""
    return warnings.groupBy("uid").agg(F.max("no_login_time").alias("no_login_time"))
