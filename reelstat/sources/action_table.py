"""User actions stored so that ranges of time and sessions both leave most of the table unread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Bits of each of the two keys that are interleaved.
BITS = 16
# Bytes of a row group; the smaller they are, the less is read beside a range.
GROUP_BYTES = 8 << 20


def _scaled(value: Column, low: float, high: float) -> Column:
    """Where a value lies between two others, in BITS bits; a null value lies lowest."""
    top = (1 << BITS) - 1
    if not high > low:
        return F.lit(0).cast("long")
    place = F.floor((value.cast("double") - low) / (high - low) * top)
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(top), place)), F.lit(0)).cast("long")


def _prefix(text: Column) -> Column:
    """The first six bytes of a text as a number that orders like them."""
    return F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("long")


def _interleaved(one: Column, two: Column) -> Column:
    """The bits of two keys in turn, those of ``one`` first: near in the result means near in both."""
    key = F.lit(0).cast("long")
    for bit in range(BITS):
        for shift, column in ((1, one), (0, two)):
            digit = F.shiftright(column, bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(digit, 2 * bit + shift))
    return key


def write_actions(actions: DataFrame, path: str, files: int | None = None, group_bytes: int = GROUP_BYTES) -> None:
    """Write actions clustered on ``date`` and ``sessionId`` at once.

    Rows are dealt to files by ranges of the interleaved bits of both, so a row group holds a short stretch of time of
    neighbouring sessions. Rows of one key are spread by a hash, so that no file grows with them.
    """
    session = _prefix(F.col("sessionId"))
    ends = actions.agg(F.min("date"), F.max("date"), F.min(session), F.max(session)).first()
    low, high, first, last = (float(e or 0) for e in ends)
    key = _interleaved(_scaled(F.col("date"), low, high), _scaled(session, first, last))
    keyed = actions.withColumn("_key", key).withColumn("_spread", F.xxhash64("date", "sessionId"))
    order = ["_key", "_spread"]
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    sorted_ = dealt.sortWithinPartitions(*order).drop(*order)
    sorted_.write.option("parquet.block.size", str(group_bytes)).parquet(path)


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """The stored actions; conditions on ``date`` or ``sessionId`` leave row groups out."""
    return spark.read.parquet(path)
