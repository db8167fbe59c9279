"""Text features of movies: hashed term frequencies weighted by inverse document frequency."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

# Columns a movie must have, and those that make up its text.
REQUIRED = (
    "mid",
    "movie_name",
    "img_urls",
    "directors",
    "main_actors",
    "categories",
    "language",
    "location",
)
FEATURES = ("directors", "main_actors", "categories", "language", "location")


def movie_words(movies: DataFrame, legacy_join: bool = False) -> DataFrame:
    """(mid, words text) of the movies that have every required column.

    Multi-valued columns become space-separated. ``legacy_join`` puts commas between the
    columns, which fuses the last word of one with the first of the next.
    """
    complete = movies.dropna(subset=list(REQUIRED))
    words = [F.replace(F.col(c), F.lit("|"), F.lit(" ")) for c in FEATURES]
    text = F.concat_ws("," if legacy_join else " ", *words)
    return complete.select("mid", text.alias("text"))


def content_features(
    movies: DataFrame, num_features: int = 500, legacy_join: bool = False
) -> DataFrame:
    """(mid, features vector, vector array) of every movie.

    Fitting the weights brings one vector of ``num_features`` numbers to the driver, whatever
    the number of movies.
    """
    words = movie_words(movies, legacy_join)
    stages = [
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=num_features),
        IDF(inputCol="counts", outputCol="features"),
    ]
    model = Pipeline(stages=stages).fit(words)
    return model.transform(words).select(
        "mid", "features", vector_to_array("features").alias("vector")
    )


def feature_weights(features: DataFrame) -> DataFrame:
    """Non-zero weights in long form (mid, idx, weight)."""
    return features.select("mid", F.posexplode("vector").alias("idx", "weight")).where(
        F.col("weight") != 0
    )
