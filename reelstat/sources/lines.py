"""Pipe-separated text events to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from reelstat import schemas


_BAD = "_bad"


def _typed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Each line once through the built-in separator parser, with its fields and a ``_ok`` flag.

    A line is good when it has one part per field and every non-empty part has the type of its
    field; an empty part is null. The generator keeps filters on the fields from repeating the
    parse.
    """
    options = {"sep": "|", "quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    declared = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col("value"), f"{declared}, {_BAD} string", options)
    fields = lines.select("value", F.inline(F.array(parsed)))
    return fields.withColumn("_ok", F.col(_BAD).isNull() & (F.length("value") > 0)).drop(_BAD)


def parse_lines(lines: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows of the good lines, without those that lack a required field."""
    typed = _typed(lines, schema).where("_ok")
    for name in required:
        typed = typed.where(F.col(name).isNotNull())
    return typed.select(*schema.fieldNames())


def rejected_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines that do not parse, unchanged."""
    return _typed(lines, schema).where(~F.col("_ok")).select("value")


def parse_ratings(lines: DataFrame) -> DataFrame:
    """``uid|mid|rating|date``"""
    return parse_lines(lines, schemas.RATING_LINE, ("uid", "mid"))


def parse_log_events(lines: DataFrame, required: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """``uid|ip|mid|event|timestamp``; user and movie may be empty."""
    return parse_lines(lines, schemas.LOG_LINE, required)


def parse_plays(lines: DataFrame) -> DataFrame:
    """Play events of a known movie."""
    return parse_log_events(lines, ("mid", "timestamp")).where(F.col("event") == "play")


def parse_logins(lines: DataFrame) -> DataFrame:
    """``uid|ip|success or fail|timestamp``"""
    return parse_lines(lines, schemas.LOGIN_LINE, ("uid", "eventType", "timestamp"))
