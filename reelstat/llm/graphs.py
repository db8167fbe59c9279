"""Connected components as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelstat.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): the root is the smallest node reachable.

    Large-star and small-star rounds: each node's neighbours above it, then those below it, are tied to the smallest of
    its neighbourhood. The rounds grow with the logarithm of the longest path, and a node with very many neighbours is
    only counted and joined, never collected. Each round is written to the shared folder.
    """
    links = stored(_clean(edges), "links")
    before = None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(_clean(large), "links")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            small.select("a", F.col("m").alias("b"))
        )
        links = stored(_clean(small), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())


def _clean(edges: DataFrame) -> DataFrame:
    """Each edge once, the larger node first, without loops."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
