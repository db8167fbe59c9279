"""Text features of movies that are kept up to date instead of fitted anew.

Beside the counted words of every movie the store holds how many movies of each part have a word. These document frequencies
add up over the parts, so when movies come, change or go, only they are read as text again, only their parts are
written, and the weights of all others follow from the new sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelstat.operators.content import movie_words
from reelstat.session import saved

# Parts that movies are hashed into.
PARTS = 64
TERMS = "mid long, digest long, at array<int>, counts array<double>, part int"
FREQUENCIES = "at int, movies long, part int"
# Stands for the number of movies of a part among its words.
ALL = -1


class FeatureStore:
    """Counted words and their document frequencies under ``path``. Sizes must stay what they were when written."""

    def __init__(self, spark: SparkSession, path: str, num_features: int = 500, parts: int = PARTS):
        self.spark, self.path, self.num_features, self.parts = spark, path.rstrip("/"), num_features, parts

    def _part(self, mid: Column) -> Column:
        return F.pmod(F.xxhash64(mid), F.lit(self.parts)).cast("int")

    def _read(self, name: str, schema: str) -> DataFrame:
        # An empty write makes sure that the table can be read.
        empty = self.spark.createDataFrame([], schema)
        empty.write.mode("append").partitionBy("part").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _counted(self, words: DataFrame) -> DataFrame:
        """(mid, digest, at, counts) of (mid, digest, text) rows."""
        tokens = Tokenizer(inputCol="text", outputCol="words").transform(words)
        hashed = HashingTF(inputCol="words", outputCol="tf", numFeatures=self.num_features).transform(tokens)
        dense = hashed.select("mid", "digest", vector_to_array("tf").alias("tf"))
        places = F.transform("tf", lambda x, i: F.when(x != 0, i.cast("int")))
        return dense.select(
            "mid",
            "digest",
            F.filter(places, lambda i: i.isNotNull()).alias("at"),
            F.filter("tf", lambda x: x != 0).alias("counts"),
        )

    def update(self, movies: DataFrame, legacy_join: bool = False) -> int:
        """Bring the store to the state of the movie table, one row a movie; returns how many were read as text again."""
        words = movie_words(movies, legacy_join)
        now = saved(words.select("mid", F.xxhash64("text").alias("digest"), "text"))
        terms = self._read("terms", TERMS)
        before = terms.select("mid", F.col("digest").alias("was"))
        both = now.select("mid", "digest").join(before, "mid", "full")
        # Movies that came, changed or went.
        moved = saved(both.where(~F.col("digest").eqNullSafe(F.col("was"))).select("mid", "digest", self._part(F.col("mid")).alias("part")))
        touched = [row["part"] for row in moved.select("part").distinct().collect()]
        if not touched:
            return 0
        columns = ["mid", "digest", "at", "counts"]
        stay = terms.where(F.col("part").isin(touched)).join(moved.select("mid"), "mid", "left_anti").select(*columns)
        again = moved.where("digest is not null").select("mid")
        read = self._counted(now.join(again, "mid", "left_semi"))
        merged = saved(stay.unionByName(read.select(*columns)).withColumn("part", self._part(F.col("mid"))))
        self._replace("terms", merged, touched)
        # The frequencies of a part come from its terms, so an update that runs again repairs what an earlier one left.
        each = merged.select("part", F.explode(F.concat("at", F.array(F.lit(ALL)))).alias("at"))
        self._replace("frequencies", each.groupBy("at", "part").agg(F.count("*").alias("movies")), touched)
        return again.count()

    def _replace(self, name: str, rows: DataFrame, touched: list[int]) -> None:
        rows = saved(rows)
        writer = rows.repartition("part").write.mode("overwrite").partitionBy("part")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{name}")
        left = {row["part"] for row in rows.select("part").distinct().collect()}
        for part in touched:
            if part not in left:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/part={part}")
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def weights(self) -> np.ndarray:
        """The inverse document frequency of every feature; ``num_features`` numbers, whatever the number of movies."""
        sums = self._read("frequencies", FREQUENCIES).groupBy("at").agg(F.sum("movies").alias("movies")).collect()
        movies = {row["at"]: row["movies"] for row in sums}
        held = np.array([movies.get(k, 0) for k in range(self.num_features)], float)
        return np.log((movies.get(ALL, 0) + 1.0) / (held + 1.0))

    def features(self) -> DataFrame:
        """(mid, vector array) of every movie, as a fit over all movies would give it."""
        weights = self.weights()

        def weighed(batches):
            for batch in batches:
                at, counts = batch.column(1), batch.column(2)
                rows = np.zeros((batch.num_rows, len(weights)))
                row = np.repeat(np.arange(batch.num_rows), at.value_lengths().to_numpy())
                place = at.flatten().to_numpy()
                rows[row, place] = counts.flatten().to_numpy() * weights[place]
                ends = pa.array(np.arange(len(rows) + 1) * len(weights), pa.int32())
                vectors = pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), vectors], names=["mid", "vector"])

        return self._read("terms", TERMS).select("mid", "at", "counts").mapInArrow(weighed, "mid long, vector array<double>")
