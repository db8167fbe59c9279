"""Top-n selections with a total order, so that ties never depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n(frame: DataFrame, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of the whole frame with their position.

    Sort and limit run as one bounded heap per task; only those ``n`` rows reach the window.
    """
    best = frame.orderBy(*order).limit(n)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


# Beyond this many rows of a group Spark plans no group limit of its own, and hashed parts of a group take its place.
GROUP_LIMIT = 1000
PARTS = 64


def placed(
    frame: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str, limit: Column | int
) -> DataFrame:
    """Rows whose place in their group is at most ``limit``, which may differ between groups.

    Hashed parts of a group are ranked first and cut to the limit, so no task sorts a whole group.
    """
    part = F.pmod(F.xxhash64(*frame.columns), F.lit(PARTS))
    within = Window.partitionBy(*keys, "_part").orderBy(*order)
    cut = frame.withColumn("_part", part).withColumn(rank, F.row_number().over(within)).where(F.col(rank) <= limit)
    window = Window.partitionBy(*keys).orderBy(*order)
    return cut.drop("_part").withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= limit)


def top_n_per_group(
    frame: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark plans a group limit before the shuffle for up to GROUP_LIMIT rows, so each task sends at most ``n`` rows per
    group however large the group is; beyond that :func:`placed` does the same.
    """
    if n > GROUP_LIMIT:
        return placed(frame, keys, order, rank, n)
    window = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


# Names of the movie fields inside result documents.
DOCUMENT_NAMES = {
    "movie_name": "movieName",
    "hot_degree": "hotDegree",
    "img_urls": "imgUrls",
    "rating_num": "ratingNum",
}


def nest(
    frame: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str, rank: str = "rank"
) -> DataFrame:
    """Fold ranked rows into one list per key, in rank order. Only for ranked, bounded groups."""
    named = [F.col(f).alias(DOCUMENT_NAMES.get(f, f)) for f in fields]
    entries = F.array_sort(F.collect_list(F.struct(F.col(rank), F.struct(*named).alias("entry"))))
    return frame.groupBy(*keys).agg(F.transform(entries, lambda e: e["entry"]).alias(name))
