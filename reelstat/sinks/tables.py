"""Append-only result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_table(frame: DataFrame, path: str, partition_by: tuple[str, ...] = ("date",)) -> None:
    """Append rows, flat or nested, to a parquet table partitioned by date."""
    keys = [c for c in partition_by if c in frame.columns]
    frame.write.mode("append").partitionBy(*keys).parquet(path)


def write_batch(
    frame: DataFrame,
    batch_id: int,
    path: str,
    partition_by: tuple[str, ...] = (),
    cluster_by: tuple[str, ...] = (),
) -> None:
    """Write the rows of one micro-batch to its own partition.

    A batch that runs again after a failure replaces its partition, so rows arrive exactly once.
    Rows in the order of ``cluster_by`` keep a task within few partitions, and a crowded
    partition is still split between tasks, where one task per partition would not be.
    """
    if cluster_by:
        frame = frame.repartitionByRange(*cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    target = f"{path.rstrip('/')}/batch_id={batch_id}"
    frame.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
