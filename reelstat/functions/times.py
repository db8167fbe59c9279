"""Expressions on dates given as text and on epoch milliseconds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

DAY_MS = 86_400_000


def as_date(as_of: dt.date | str) -> dt.date:
    """The reference date of a job as a date."""
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    if isinstance(as_of, dt.date):
        return as_of
    return dt.date.fromisoformat(as_of[:10])


def as_text(as_of: dt.date | str) -> str:
    return as_date(as_of).isoformat()


def epoch_ms(day: dt.date | str) -> int:
    """Milliseconds at midnight UTC of a day."""
    return (as_date(day) - dt.date(1970, 1, 1)).days * DAY_MS


def release_day(column: Column) -> Column:
    """Date in the first ten characters; null when too short, bracketed or not a date."""
    head = F.substring(column, 1, 10)
    usable = (F.length(column) >= 10) & ~head.contains("(")
    return F.when(usable, head.try_cast("date"))


def hours_since(day: Column, as_of: dt.date | str) -> Column:
    """Whole days since ``day`` in hours, never negative."""
    return F.greatest(F.datediff(F.lit(as_date(as_of)), day) * 24, F.lit(0))


def week_of(as_of: dt.date | str) -> tuple[dt.date, dt.date]:
    """Monday and Sunday of the week."""
    day = as_date(as_of)
    monday = day - dt.timedelta(days=day.weekday())
    return monday, monday + dt.timedelta(days=6)


def period_bounds(as_of: dt.date | str, period: str) -> tuple[dt.datetime, dt.datetime]:
    """First moment of the month or week of a day, and the moment before which it ends.

    A week ends on Sunday at 23:59:59.
    """
    day = as_date(as_of)
    if period == "month":
        following = (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return dt.datetime.combine(day.replace(day=1), dt.time()), dt.datetime.combine(following, dt.time())
    if period == "week":
        monday, sunday = week_of(day)
        return dt.datetime.combine(monday, dt.time()), dt.datetime.combine(sunday, dt.time(23, 59, 59))
    raise ValueError(f"unknown period: {period!r}")


def hour_label(millis: Column) -> Column:
    """``yyyy-MM-dd-HH`` label in UTC of an epoch-millisecond value, whatever the session's time zone."""
    hours = F.floor(millis / 3_600_000)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(hours / 24).cast("int"))
    return F.concat_ws("-", day.cast("string"), F.lpad(F.pmod(hours, F.lit(24)).cast("string"), 2, "0"))
