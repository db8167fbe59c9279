"""A number kept from micro-batch to micro-batch."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F


class Progress:
    """Value after each batch, kept in two alternating slots.

    Batch ``n`` reads the slot of batch ``n - 1`` and writes the other one, so a repeated batch
    finds its input unchanged and the storage stays constant.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _slot(self, batch_id: int) -> str:
        return f"{self.folder}/slot={batch_id % 2}"

    def before(self, batch_id: int) -> int | None:
        """Value left by the previous batch; None before the first one."""
        if batch_id == 0:
            return None
        row = self.spark.read.schema("batch long, value long").parquet(self._slot(batch_id - 1)).first()
        if row is None or row.batch != batch_id - 1:
            raise RuntimeError(f"nothing kept for batch {batch_id - 1}")
        return row.value

    def after(self, batch_id: int, value: int | None) -> None:
        kept = self.spark.range(1).select(
            F.lit(batch_id).cast("long").alias("batch"), F.lit(value).cast("long").alias("value")
        )
        kept.coalesce(1).write.mode("overwrite").parquet(self._slot(batch_id))


def larger(first: int | None, second: int | None) -> int | None:
    """The larger of two values, either of which may be missing."""
    known = [value for value in (first, second) if value is not None]
    return max(known, default=None)
