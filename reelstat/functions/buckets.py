"""Closed value ranges, first match wins."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, functions as F


class Bucket(NamedTuple):
    """``low <= value <= high``; without ``high`` the range is ``value > low``."""

    label: str
    low: int
    high: int | None = None

    def holds(self, value: Column) -> Column:
        return value > self.low if self.high is None else value.between(self.low, self.high)


# Session visit lengths in seconds and step counts.
VISIT_BUCKETS = (
    Bucket("1s_3s", 1, 3),
    Bucket("4s_6s", 4, 6),
    Bucket("7s_9s", 7, 9),
    Bucket("10s_30s", 10, 30),
    Bucket("30s_60s", 30, 60),
    Bucket("1m_3m", 60, 180),
    Bucket("3m_10m", 180, 600),
    Bucket("10m_30m", 600, 1800),
    Bucket("30m", 1800),
)
STEP_BUCKETS = (
    Bucket("1_3", 1, 3),
    Bucket("4_6", 4, 6),
    Bucket("7_9", 7, 9),
    Bucket("10_30", 10, 30),
    Bucket("30_60", 30, 60),
    Bucket("60", 60),
)


def bucket_label(value: Column, buckets: Sequence[Bucket]) -> Column:
    """Label of the first bucket that holds the value, null when none does."""
    return F.coalesce(*[F.when(b.holds(value), F.lit(b.label)) for b in buckets])


def parse_buckets(text: str) -> tuple[Bucket, ...]:
    """Read ``1-3,4-6,60`` as buckets; a single number is an open range."""
    found = []
    for part in (p.strip() for p in text.split(",")):
        low, _, high = part.partition("-")
        found.append(Bucket(part.replace("-", "_"), int(low), int(high) if high else None))
    return tuple(found)
