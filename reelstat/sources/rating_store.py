"""Ratings laid out by user, so that the history of a few users is read without the rest of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelstat.session import broadcast_if_small, saved, shuffles_dropped

# Parts that users are hashed into; a read opens the parts of its users only.
PARTS = 64
_INITIAL = -1


class RatingStore:
    """Rows (uid, ...) under ``path``, by the arrival that brought them and by a hash of the user."""

    def __init__(self, spark: SparkSession, path: str, schema: str, parts: int = PARTS):
        """``schema`` names the columns, of which ``uid`` must be one. ``parts`` must stay what it was when written."""
        self.spark, self.path, self.schema, self.parts = spark, path.rstrip("/"), schema, parts

    def _part(self, uid: Column) -> Column:
        return F.pmod(F.xxhash64(uid.cast("long")), F.lit(self.parts)).cast("int")

    def _write(self, ratings: DataFrame, arrival: int) -> None:
        columns = self.spark.createDataFrame([], self.schema).columns
        placed = ratings.select(*columns).withColumn("part", self._part(F.col("uid")))
        # A part is written by one task or, if a user fills it, by a few.
        dealt = placed.repartitionByRange("part", F.xxhash64(*columns)).sortWithinPartitions("part", "uid")
        with shuffles_dropped(self.spark):
            dealt.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/arrival={arrival}")

    def create(self, ratings: DataFrame) -> None:
        """Write what is known so far."""
        self._write(ratings, _INITIAL)

    def append(self, ratings: DataFrame, arrival: int) -> None:
        """Add the ratings of an arrival, a number from 0 on; one that comes again replaces what it wrote."""
        if arrival < 0:
            raise ValueError("arrivals are numbered from 0 on")
        self._write(ratings, arrival)

    def table(self) -> DataFrame:
        """All ratings, with the part of their user."""
        read = self.spark.read.schema(f"{self.schema}, arrival int, part int").option("basePath", self.path)
        return read.parquet(self.path).drop("arrival")

    def of_users(self, users: DataFrame) -> DataFrame:
        """The ratings of the users (uid), read from their parts."""
        wanted = broadcast_if_small(saved(users.select("uid").where("uid is not null").distinct()))
        touched = [row[0] for row in wanted.select(self._part(F.col("uid"))).distinct().collect()]
        kept = self.table().where(F.col("part").isin(touched) if touched else F.lit(False))
        return kept.drop("part").join(wanted, "uid", "left_semi")
