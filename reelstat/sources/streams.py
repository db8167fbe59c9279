"""Streams of text lines (column ``value``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(
    servers: str, topic: str, starting: str = "latest", per_trigger: int | None = None
) -> dict[str, str]:
    """Source options. Positions live in the checkpoint of the query."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_lines(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    per_trigger: int | None = None,
) -> DataFrame:
    """Lines of a Kafka topic; needs the Kafka connector on the class path."""
    options = kafka_options(servers, topic, starting, per_trigger)
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def event_time(events: DataFrame, delay: str, column: str = "timestamp") -> DataFrame:
    """Add ``ts`` from epoch milliseconds and accept rows that are up to ``delay`` out of order."""
    return events.withColumn("ts", F.timestamp_millis(F.col(column))).withWatermark("ts", delay)
