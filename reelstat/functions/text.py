"""Expressions on names and multi-valued strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def category_list(column: Column) -> Column:
    """Categories are separated by ``|`` or ``,``."""
    return F.split(column, "[|,]")


def contains_any(column: Column, terms: Sequence[str]) -> Column:
    """True when the text holds one of the terms; null text gives false."""
    found = F.lit(False)
    for term in terms:
        found = found | column.contains(term)
    return F.coalesce(found, F.lit(False))


def first_positive(*columns: str) -> Column:
    """First of the columns that is above zero, else null."""
    return F.coalesce(*[F.when(F.col(c) > 0, F.col(c)) for c in columns])
