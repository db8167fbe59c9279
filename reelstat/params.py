"""Job parameters, also readable from a ``key=value`` property file."""

from __future__ import annotations

import dataclasses
import pathlib
from collections.abc import Mapping

from reelstat.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS, Bucket, parse_buckets


def load_properties(path: str) -> dict[str, str]:
    """Entries of a property file; blank lines and ``#`` comments are skipped."""
    entries = {}
    for line in pathlib.Path(path).read_text(encoding="utf-8").splitlines():
        line = line.strip()
        if line and not line.startswith("#"):
            key, _, value = line.partition("=")
            entries[key.strip()] = value.strip()
    return entries


def _items(text: str | None) -> tuple[str, ...] | None:
    return tuple(p.strip() for p in text.split(",") if p.strip()) if text else None


@dataclasses.dataclass(frozen=True)
class JobParams:
    """Filters and sizes of the session, funnel and area jobs. None means no condition."""

    start_date: str | None = None
    end_date: str | None = None
    inclusive_end_day: bool = False
    age: tuple[int, int] | None = None
    cities: tuple[str, ...] | None = None
    professions: tuple[str, ...] | None = None
    sex: int | None = None
    categories: tuple[int, ...] | None = None
    visit_buckets: tuple[Bucket, ...] = VISIT_BUCKETS
    step_buckets: tuple[Bucket, ...] = STEP_BUCKETS
    top_movies: int = 10

    @classmethod
    def from_properties(cls, entries: Mapping[str, str]) -> JobParams:
        """Read the known keys; absent ones keep their defaults."""
        age = _items(entries.get("filter.age", "").replace("-", ","))
        categories = _items(entries.get("filter.categories"))
        visit = entries.get("session.visitLength")
        steps = entries.get("session.stepLength")
        return cls(
            start_date=entries.get("filter.start.date"),
            end_date=entries.get("filter.end.date"),
            age=(int(age[0]), int(age[1])) if age else None,
            cities=_items(entries.get("filter.cities")),
            professions=_items(entries.get("filter.professional")),
            sex=int(entries["filter.sex"]) if entries.get("filter.sex") else None,
            categories=tuple(int(c) for c in categories) if categories else None,
            visit_buckets=parse_buckets(visit) if visit else VISIT_BUCKETS,
            step_buckets=parse_buckets(steps) if steps else STEP_BUCKETS,
            top_movies=int(entries.get("top.movies.count", 10)),
        )
