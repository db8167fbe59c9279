"""The corpus pipeline: quality rules, near-duplicates, repeated passages, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelstat.llm import mixing, neardup, packing, rules, substrings
from reelstat.llm.common import stored, table

# (name, function of (spark, docs, folder)); each reads all that the stage before it kept.
STAGES = [
    ("quality_rules", rules.stage),
    ("near_duplicates", neardup.stage),
    ("repeated_passages", substrings.stage),
    ("source_mix", mixing.stage),
    ("packing", packing.stage),
]

# Quantile sketches, signatures and tokenizers have no SQL form; the tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
