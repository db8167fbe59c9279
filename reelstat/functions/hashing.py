"""Polynomial string hash onto a bitmap position."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Hash seed and bitmap size in bits.
BITMAP_SEED = 61
BITMAP_BITS = 1 << 23


def bitmap_offset(text: Column, seed: int = BITMAP_SEED, bits: int = BITMAP_BITS) -> Column:
    """Position of a text in a bitmap of ``bits`` (a power of two) positions.

    The running value is masked at every character, which gives the same position as masking
    once at the end and keeps the arithmetic far from overflow.
    """
    mask = F.lit(bits - 1).cast("long")
    return F.aggregate(
        F.split(text, ""),
        F.lit(0).cast("long"),
        lambda value, char: (value * seed + F.ascii(char)).bitwiseAND(mask),
    )
