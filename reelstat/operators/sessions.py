"""Session aggregation, filters, length statistics, top categories and their top sessions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelstat.functions import buckets as B, ranking, scores, text, times
from reelstat.session import broadcast_if_small, saved

CATEGORY_KINDS = ("click", "collect", "rating", "comment")
DETAIL = (
    "userId",
    "sessionId",
    "pageId",
    "actionTime",
    "searchKeyword",
    "clickCategoryId",
    "collectCategoryId",
    "ratingCategoryId",
    "commentCategoryId",
    "clickMovieId",
    "collectMovieId",
    "ratingMovieId",
    "commentMovieId",
    "cityId",
)


def actions_between(
    actions: DataFrame, start: dt.date | str, end: dt.date | str, inclusive_end_day: bool = False
) -> DataFrame:
    """Actions from midnight of ``start`` to midnight of ``end``, both included.

    ``inclusive_end_day`` keeps the whole end day. The range is on the raw column, so it prunes
    partitions and row groups.
    """
    last = times.epoch_ms(end) + (times.DAY_MS - 1 if inclusive_end_day else 0)
    return actions.where(F.col("date").between(times.epoch_ms(start), last))


# Values of a session that lie in one part of its list.
PART_VALUES = 1000


def session_values(actions: DataFrame, width: int = PART_VALUES) -> DataFrame:
    """The different keywords and clicked categories of every session, as (sessionId, kind, part, values).

    ``kind`` is ``keyword`` or ``category``. A part holds at most ``width`` values; parts and values are in order, numbers by
    size. Values are made unique before they are put in order, so a session costs as much as it has different ones, and
    none is gathered as a whole.
    """
    entry = lambda kind, number, text_: F.struct(F.lit(kind).alias("kind"), number.alias("number"), text_.alias("value"))
    category = F.col("clickCategoryId").cast("long")
    nothing = F.lit(None).cast("long")
    entries = F.array(
        entry("keyword", nothing, F.col("searchKeyword").cast("string")), entry("category", category, category.cast("string"))
    )
    each = actions.select("sessionId", F.explode(entries).alias("e")).select("sessionId", "e.*").where("value is not null")
    order = Window.partitionBy("sessionId", "kind").orderBy("number", "value")
    placed = each.distinct().repartition("sessionId").withColumn("place", F.row_number().over(order))
    part = F.floor((F.col("place") - 1) / width).alias("part")
    listed = placed.groupBy("sessionId", "kind", part).agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("of"))
    return listed.select("sessionId", "kind", "part", F.col("of.value").alias("values"))


# Columns of a session beside its values.
COUNTED = ("visitLength", "stepLength", "startTime", "age", "professional", "city", "sex")


def session_counters(actions: DataFrame, users: DataFrame) -> DataFrame:
    """One row per session of a known user: length, steps and profile, without keywords and categories.

    One hash aggregation, of which a task sends one row per session, whatever the number of actions in it.
    """
    counted = actions.groupBy("sessionId").agg(
        F.min("userId").alias("userId"),
        F.min("date").alias("startTime"),
        F.max("date").alias("endTime"),
        F.count("*").alias("stepLength"),
    )
    profile = users.select("userId", "age", "professional", "city", "sex")
    length = (F.col("endTime") - F.col("startTime")).alias("visitLength")
    return counted.join(profile, "userId").select("sessionId", length, *COUNTED[1:])


def session_aggregate(actions: DataFrame, users: DataFrame) -> DataFrame:
    """One row per session of a known user: keywords, categories, length, steps and profile.

    The values come from :func:`session_values` in parts, which are strung together last.
    """
    parts = F.struct("part", F.col("values"))
    # Parts are in order, and so are the values in them.
    strung = lambda kind: F.flatten(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, parts)))["values"])
    lists = session_values(actions).groupBy("sessionId").agg(
        strung("keyword").alias("keywords"), strung("category").alias("clicked")
    )
    joined = lambda name: F.coalesce(F.array_join(name, "-"), F.lit(""))
    return session_counters(actions, users).join(lists, "sessionId", "left").select(
        "sessionId",
        joined("keywords").alias("searchKeywords"),
        joined("clicked").alias("clickCategoryIds"),
        F.coalesce(F.col("clicked").cast("array<bigint>"), F.array().cast("array<bigint>")).alias("categories"),
        *COUNTED,
    )


def matching_users(
    users: DataFrame,
    age: tuple[int, int] | None = None,
    cities: Sequence[str] | None = None,
    professions: Sequence[str] | None = None,
    sex: int | None = None,
) -> DataFrame:
    """Rows with a user profile that meet every given condition; an omitted one lets everything through."""
    kept = users
    if age is not None:
        kept = kept.where(F.col("age").between(*age))
    if cities is not None:
        kept = kept.where(F.col("city").isin(list(cities)))
    if professions is not None:
        kept = kept.where(F.col("professional").isin(list(professions)))
    if sex is not None:
        kept = kept.where(F.col("sex") == sex)
    return kept


def session_filter(
    sessions: DataFrame,
    age: tuple[int, int] | None = None,
    cities: Sequence[str] | None = None,
    professions: Sequence[str] | None = None,
    sex: int | None = None,
    categories: Sequence[int] | None = None,
) -> DataFrame:
    """Sessions that meet every given condition; an omitted one lets everything through."""
    kept = matching_users(sessions, age, cities, professions, sex)
    if categories is not None:
        wanted = F.array(*[F.lit(c).cast("long") for c in categories])
        kept = kept.where(F.arrays_overlap("categories", wanted))
    return kept


def filtered_sessions(
    actions: DataFrame,
    users: DataFrame,
    age: tuple[int, int] | None = None,
    cities: Sequence[str] | None = None,
    professions: Sequence[str] | None = None,
    sex: int | None = None,
    categories: Sequence[int] | None = None,
) -> DataFrame:
    """:func:`session_filter` of :func:`session_aggregate`, with the conditions on users applied first.

    A session belongs to one user, so the actions of all other users are dropped before sessions are shuffled.
    """
    chosen = matching_users(users, age, cities, professions, sex)
    own = actions.join(chosen.select("userId"), "userId", "left_semi")
    return session_filter(session_aggregate(own, chosen), categories=categories)


def filtered_counters(
    actions: DataFrame,
    users: DataFrame,
    age: tuple[int, int] | None = None,
    cities: Sequence[str] | None = None,
    professions: Sequence[str] | None = None,
    sex: int | None = None,
    categories: Sequence[int] | None = None,
) -> DataFrame:
    """The counters of the sessions of :func:`filtered_sessions`, without stringing their values together.

    A session has a wanted category if one of its clicks has it.
    """
    chosen = matching_users(users, age, cities, professions, sex)
    own = actions.join(chosen.select("userId"), "userId", "left_semi")
    counters = session_counters(own, chosen)
    if categories is None:
        return counters
    clicked = own.where(F.col("clickCategoryId").isin(list(categories))).select("sessionId").distinct()
    return counters.join(clicked, "sessionId", "left_semi")


def actions_of_sessions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the given sessions."""
    return actions.join(sessions.select("sessionId"), "sessionId", "left_semi")


def session_length_stats(
    sessions: DataFrame,
    as_of: dt.date | str,
    visit_buckets: Sequence[B.Bucket] = B.VISIT_BUCKETS,
    step_buckets: Sequence[B.Bucket] = B.STEP_BUCKETS,
) -> DataFrame:
    """Session count and the share of every length bucket, as (date, key, value) rows.

    One aggregation of conditional counts: each task sends a single row.
    """
    bucketed = sessions.select(
        B.bucket_label(F.floor(F.col("visitLength") / 1000), visit_buckets).alias("visit"),
        B.bucket_label(F.col("stepLength"), step_buckets).alias("step"),
    )
    slots = [("visit", f"visit_length_ratio_{b.label}", b.label) for b in visit_buckets]
    slots += [("step", f"step_length_ratio_{b.label}", b.label) for b in step_buckets]
    totals = bucketed.agg(
        F.count("*").alias("session_count"),
        *[F.count_if(F.col(kind) == label).alias(key) for kind, key, label in slots],
    )
    shares = totals.select(
        F.lit(times.as_text(as_of)).alias("date"),
        F.col("session_count").cast("double").alias("session_count"),
        *[scores.ratio(F.col(key), F.col("session_count")).alias(key) for _, key, _ in slots],
    )
    return shares.unpivot(["date"], ["session_count"] + [s[1] for s in slots], "key", "value")


def stats_document(stats: DataFrame) -> DataFrame:
    """The length statistics as one map per date; its size is the number of buckets."""
    entries = F.map_from_entries(F.collect_list(F.struct("key", "value")))
    return stats.groupBy("date").agg(entries.alias("statisticsMap"))


def top_categories(actions: DataFrame, as_of: dt.date | str, n: int = 10) -> DataFrame:
    """Categories with the most clicks, then collections, ratings and comments.

    The four id columns are unpivoted and counted together, one shuffle of one partial row per
    task and category.
    """
    ids = [f"{kind}CategoryId" for kind in CATEGORY_KINDS]
    uses = actions.select(*ids).unpivot([], ids, "kind", "categoryId")
    counted = (
        uses.where(F.col("categoryId").isNotNull())
        .groupBy("categoryId")
        .agg(*[F.count_if(F.col("kind") == i).alias(f"{k}Count") for i, k in zip(ids, CATEGORY_KINDS)])
    )
    order = [F.desc(f"{kind}Count") for kind in CATEGORY_KINDS] + [F.asc("categoryId")]
    best = ranking.top_n(counted, order, n)
    return best.select(
        F.lit(times.as_text(as_of)).alias("date"),
        "categoryId",
        *[f"{kind}Count" for kind in CATEGORY_KINDS],
        "rank",
    )


def action_category() -> Column:
    """Category of one action: comment before rating, collection and click; 0 for none."""
    last_wins = [f"{kind}CategoryId" for kind in reversed(CATEGORY_KINDS)]
    return F.coalesce(text.first_positive(*last_wins), F.lit(0).cast("long"))


def top_sessions_of_category(
    actions: DataFrame, top: DataFrame, as_of: dt.date | str, n: int = 50
) -> DataFrame:
    """For each top category the sessions with the most actions in it.

    Actions of other categories are dropped before the counting shuffle; the category list is
    the output of a limit, so Spark knows its size and broadcasts it if it is small enough.
    """
    tagged = actions.select("sessionId", "userId", action_category().alias("categoryId"))
    counted = (
        tagged.where(F.col("categoryId") > 0)
        .join(top.select("categoryId"), "categoryId", "left_semi")
        .groupBy("categoryId", "sessionId")
        .agg(F.min("userId").alias("userId"), F.count("*").alias("count"))
    )
    best = ranking.top_n_per_group(
        counted, ["categoryId"], [F.desc("count"), F.asc("sessionId")], n
    )
    return best.select(
        F.lit(times.as_text(as_of)).alias("date"),
        "categoryId",
        "userId",
        "sessionId",
        "count",
        "rank",
    )


def session_details(actions: DataFrame, top_sessions: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Raw actions of the top sessions, each once.

    The session ids are saved and counted first: a short list is broadcast and the actions are
    only scanned; a longer one is joined by shuffle.
    """
    wanted = broadcast_if_small(saved(top_sessions.select("sessionId").distinct()))
    return (
        actions.join(wanted, "sessionId", "left_semi")
        .withColumnRenamed("date", "actionTime")
        .select(F.lit(times.as_text(as_of)).alias("date"), *DETAIL)
    )
