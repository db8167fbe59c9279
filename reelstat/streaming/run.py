"""Start streaming queries. Positions and state live in the checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

# Keeps large state on local disk, with its changes in the checkpoint, instead of on the heap.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def use_state_store(spark: SparkSession) -> None:
    """Choose the state store of queries started from now on."""
    spark.conf.set(_PROVIDER, _STORE)
    spark.conf.set(_CHANGES, "true")


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Fixed interval, or everything available now and stop."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def to_batches(
    frame: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    interval: str | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``write``, which must be idempotent on the batch id."""
    use_state_store(frame.sparkSession)
    writer = frame.writeStream.foreachBatch(write).outputMode(mode)
    return _triggered(writer.option("checkpointLocation", checkpoint), interval).start()


def to_console(
    frame: DataFrame, checkpoint: str, mode: str = "update", interval: str | None = None
) -> StreamingQuery:
    """Print every micro-batch."""
    use_state_store(frame.sparkSession)
    writer = frame.writeStream.format("console").outputMode(mode).option("truncate", "false")
    return _triggered(writer.option("checkpointLocation", checkpoint), interval).start()
