"""Readers for stored tables. Each returns columns of a declared schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns by name and cast them; a missing column is an error.

    Text that does not parse as its declared type becomes null.
    """
    missing = [name for name in schema.fieldNames() if name not in frame.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return frame.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return conform(spark.read.parquet(path), schema)


def read_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A catalog table, for example one kept by a Hive metastore."""
    return conform(spark.table(name), schema)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 200,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options; with a numeric column and its bounds the table is read in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, schema: T.StructType, **arguments) -> DataFrame:
    """A database table. Filters on the result are pushed to the database."""
    return conform(spark.read.format("jdbc").options(**jdbc_options(**arguments)).load(), schema)
