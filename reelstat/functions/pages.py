"""Page kinds of the conversion funnel."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Page kinds in matching order, and the steps that are counted.
PAGE_KINDS = ("detail", "index", "comment", "rating", "collect", "play")
FUNNEL_STEPS = (
    ("index", "detail"),
    ("detail", "comment"),
    ("detail", "rating"),
    ("detail", "collect"),
    ("detail", "play"),
)


def page_kind(page: Column) -> Column:
    """First kind whose name occurs in the page id, null for other pages."""
    return F.coalesce(*[F.when(page.contains(kind), F.lit(kind)) for kind in PAGE_KINDS])
