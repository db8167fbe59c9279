"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelstat.llm import (
    mixing,
    neardup,
    neighbours,
    packing,
    pages,
    periodic,
    quality,
    rules,
    sharding,
    substrings,
    token_files,
    toxicity,
    whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": packing.op1_packing,
        "op2_html": pages.op2_html,
        "op3_mixing": mixing.op3_mixing,
        "op4_suffix_array": substrings.op4_suffix_array,
        "op5_sharding": sharding.op5_sharding,
        "op6_minhash": neardup.op6_minhash,
        "op7_quality_rules": rules.op7_quality_rules,
        "op8_quality": quality.op8_quality,
        "op9_rotated_codes": neighbours.op9_rotated_codes,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_periodic": periodic.op11_periodic,
        "op12_token_files": token_files.op12_token_files,
        "op13_whitening": whitening.op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mixing": mixing.OP3_SQL,
        "op4_suffix_array": substrings.OP4_SQL,
        "op6_minhash": neardup.OP6_SQL,
        "op9_rotated_codes": neighbours.OP9_SQL,
        "op11_periodic": periodic.OP11_SQL,
    }
