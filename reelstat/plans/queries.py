"""Named queries over a folder of parquet tables; each returns flat rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from reelstat import schemas
from reelstat.operators import (
    area,
    content,
    funnel,
    hot_movies,
    leaderboards,
    logins,
    neighbour_index,
    popularity,
    recommend,
    sessions,
    similarity,
    visitors,
)
from reelstat.operators.feature_store import FeatureStore
from reelstat.plans import domain
from reelstat.plans.domain import AS_OF, Domain, StreamedDomain
from reelstat.session import saved, scratch_path, shuffles_dropped
from reelstat.sources import action_table, lines, streams
from reelstat.sources.rating_store import RatingStore
from reelstat.streaming import (
    hot_movies as stream_hot,
    late as stream_late,
    logins as stream_logins,
    recommend as stream_recommend,
    visitors as stream_visitors,
)

Query = Callable[[SparkSession, str], DataFrame]

# Stored doubles are compared after rounding to this many decimals.
SHOWN = 6

# The login data has hours between the events of a user.
LOGIN_GAP_MS = 6 * 3_600_000

SESSION_TIE = ("event_id",)


def shown(name: str) -> Column:
    return F.round(name, SHOWN).alias(name)


def _counts(d: Domain) -> DataFrame:
    return popularity.movie_activity_counts(
        d.movies, d.movie_ratings, d.comments, d.collections, d.plays
    )


def _hot(d: Domain) -> DataFrame:
    return popularity.hot_degree(_counts(d), AS_OF)


def _board(board: DataFrame) -> DataFrame:
    return board.withColumn("hot_degree", F.round("hot_degree", SHOWN))


def movie_activity_counts(d: Domain) -> DataFrame:
    return _counts(d).drop(*popularity.INFO)


def hot_degree(d: Domain) -> DataFrame:
    return _hot(d).select("mid", "movie_name", "categories", shown("hot_degree"), "location")


def top_movies_by_category(d: Domain) -> DataFrame:
    return _board(leaderboards.top_movies_by_category(_hot(d), AS_OF))


def top_movies(d: Domain) -> DataFrame:
    return _board(leaderboards.top_movies(_hot(d), AS_OF, domain.ANIMATION_TAG))


def top_comics(d: Domain) -> DataFrame:
    return _board(leaderboards.top_comics(_hot(d), AS_OF, domain.ANIMATION_TAG))


def hot_ranking(d: Domain) -> DataFrame:
    return _board(leaderboards.region_ranking(_hot(d), AS_OF))


def region_ranking_na(d: Domain) -> DataFrame:
    return _board(
        leaderboards.region_ranking(_hot(d), AS_OF, "north_america", domain.NORTH_AMERICA)
    )


def region_ranking_mainland(d: Domain) -> DataFrame:
    return _board(leaderboards.region_ranking(_hot(d), AS_OF, "mainland_ranking", domain.MAINLAND))


def good_ranking(d: Domain) -> DataFrame:
    return _board(leaderboards.good_ranking(d.movies, AS_OF))


def top_movies_of_month(d: Domain) -> DataFrame:
    return leaderboards.top_movies_of_period(d.movies, d.movie_ratings, AS_OF, "month")


def top_movies_of_week(d: Domain) -> DataFrame:
    return leaderboards.top_movies_of_period(d.movies, d.movie_ratings, AS_OF, "week")


def similarity_matrix(d: Domain) -> DataFrame:
    return similarity.similarity_matrix(d.vectors).select("mid", "mid2", F.round("score", 4).alias("score"))


def _similar(frame: DataFrame) -> DataFrame:
    return frame.withColumn("score", F.round("score", 4))


def similar_movies(d: Domain) -> DataFrame:
    # Of the pairs above 0.1 each task keeps the best of a movie; the table of all of them is never written.
    nearest = similarity.nearest_movies(d.vectors, 30, 0.1).drop("rank")
    return _similar(similarity.similar_movies(nearest, d.movies, AS_OF))


def similar_movies_from_vectors(d: Domain) -> DataFrame:
    return _similar(similarity.similar_movies_from_vectors(d.vectors, d.movies, AS_OF))


def content_features(d: Domain) -> DataFrame:
    weights = content.feature_weights(content.content_features(d.movies))
    return weights.select("mid", F.col("idx").cast("long").alias("idx"), shown("weight"))


def content_similarity(d: Domain) -> DataFrame:
    features = content.content_features(d.movies).select("mid", "vector")
    return _similar(similarity.similar_movies_from_vectors(features, d.movies, AS_OF))


def updated_features(d: Domain) -> DataFrame:
    """The features after movies came, changed and went, of which only these were read as text again."""
    store = FeatureStore(d.spark, scratch_path(d.spark, "features"))
    mid = F.col("mid")
    early = d.movies.where(mid % 3 != 0).withColumn("language", F.when(mid % 5 == 0, "other").otherwise(F.col("language")))
    gone = d.movies.where(mid % 7 == 0).withColumn("mid", -1 - mid)
    store.update(early.unionByName(gone))
    store.update(d.movies)
    weights = content.feature_weights(store.features())
    return weights.select("mid", F.col("idx").cast("long").alias("idx"), shown("weight"))


def newest_ratings(d: Domain) -> DataFrame:
    """The newest rating of each user, as the event that has just arrived."""
    return d.newest_by_order.groupBy("uid").agg(F.max("newest").alias("newest")).select("uid", F.col("newest.mid").alias("mid"))


def _index(d: Domain) -> str:
    """The stored index of the movies' vectors."""
    path = scratch_path(d.spark, "neighbour-index")
    neighbour_index.build(d.vectors, path)
    return path


def realtime_recommend(d: Domain) -> DataFrame:
    arrived = scratch_path(d.spark, "newest-ratings")
    with shuffles_dropped(d.spark):
        newest_ratings(d).write.parquet(arrived)
    found = recommend.realtime_recommend(
        d.spark.read.schema("uid long, mid long").parquet(arrived),
        d.ratings,
        _index(d),
        d.movies,
        AS_OF,
        tie=Domain.RATING_TIE,
    )
    return found.withColumn("score", F.round("score", 4))


def session_aggregate(d: Domain) -> DataFrame:
    return sessions.session_aggregate(d.actions, d.users).drop("categories")


# Conditions of the filter query.
AGE = (25, 50)
CITIES = tuple(f"NATION_{number}" for number in range(15))
PROFESSIONS = ("AUTOMOBILE", "BUILDING", "MACHINERY", "HOUSEHOLD")
SEX = 1
CATEGORIES = (1, 3, 5, 7, 9)


def session_filter(d: Domain) -> DataFrame:
    kept = sessions.filtered_sessions(d.actions, d.users, AGE, CITIES, PROFESSIONS, SEX, CATEGORIES)
    return kept.drop("categories")


# Dates of the range query.
RANGE = ("2024-01-05", "2024-01-12")


# Where the actions of a folder have been stored, by application and folder.
_stored_actions: dict[tuple[str, str], str] = {}


def store_actions(d: Domain) -> str:
    """The folder of the stored actions, written by the first call."""
    key = (d.spark.sparkContext.applicationId, d.folder)
    if key not in _stored_actions:
        path = scratch_path(d.spark, "actions")
        action_table.write_actions(d.actions.withColumn("date", F.col("date") * 1000), path)
        _stored_actions[key] = path
    return _stored_actions[key]


def actions_in_range(d: Domain) -> DataFrame:
    """Actions of a date range, from the stored action table, in which the range prunes row groups."""
    stored = action_table.read_actions(d.spark, store_actions(d))
    return sessions.actions_between(stored, *RANGE).select("event_id", "date", "userId", "sessionId", "pageId")


def session_length_stats(d: Domain) -> DataFrame:
    stats = sessions.session_length_stats(sessions.session_counters(d.actions, d.users), AS_OF)
    return stats.select("date", "key", shown("value"))


def top10_categories(d: Domain) -> DataFrame:
    return sessions.top_categories(d.actions, AS_OF)


def top_sessions_of_category(d: Domain) -> DataFrame:
    return sessions.top_sessions_of_category(d.actions, top10_categories(d), AS_OF)


def top_session_details(d: Domain) -> DataFrame:
    return sessions.session_details(d.actions, top_sessions_of_category(d), AS_OF)


def page_transitions(d: Domain) -> DataFrame:
    return funnel.page_transitions(d.actions, SESSION_TIE)


def page_convert_rate(d: Domain) -> DataFrame:
    rates = funnel.page_convert_rate(d.actions, AS_OF, SESSION_TIE)
    return rates.select("date", *[shown(c) for c in rates.columns if c != "date"])


def top_movies_of_area(d: Domain) -> DataFrame:
    return area.top_movies_of_area(d.actions, d.cities, d.movies, AS_OF)


def parsed_log_events(d: Domain) -> DataFrame:
    return lines.parse_log_events(d.log_lines)


def mixed_log_events(d: Domain) -> DataFrame:
    """The good ones of lines of which some lack a field or have a broken number."""
    return lines.parse_log_events(d.raw_log_lines)


def rejected_log_lines(d: Domain) -> DataFrame:
    return lines.rejected_lines(d.raw_log_lines, schemas.LOG_LINE)


def uv_exact(d: Domain) -> DataFrame:
    return visitors.uv_count(d.log_events, "exact")


def uv_bitmap(d: Domain) -> DataFrame:
    return visitors.uv_count(d.log_events, "bitmap")


def uv_approx(d: Domain) -> DataFrame:
    """Whether the estimate of each hour lies within one visitor or five hundredths of the exact count."""
    hour = ["startTime", "endTime"]
    estimate = visitors.uv_count(d.log_events, "approx").withColumnRenamed("count", "estimate")
    both = visitors.uv_count(d.log_events, "exact").join(estimate, hour)
    off = F.abs(F.col("estimate") - F.col("count"))
    return both.select(*hour, (off <= F.greatest(F.lit(1.0), 0.05 * F.col("count"))).alias("close"))


def late_rows(d: Domain) -> DataFrame:
    """Rows that would be late after the newest event has been seen."""
    events = d.log_events
    newest = events.agg(F.max("timestamp")).first()[0]
    return stream_late.split_late(events, newest)[1]


def hot_movies_window(d: Domain) -> DataFrame:
    return hot_movies.hot_movies_window(d.log_events)


def login_fail_detect(d: Domain) -> DataFrame:
    return logins.login_fail_detect(d.logins, LOGIN_GAP_MS, tie=("event_id",))


def current_locks(d: Domain) -> DataFrame:
    return logins.current_locks(login_fail_detect(d))


_BATCH = (
    movie_activity_counts,
    hot_degree,
    top_movies_by_category,
    top_movies,
    top_comics,
    hot_ranking,
    region_ranking_na,
    region_ranking_mainland,
    good_ranking,
    top_movies_of_month,
    top_movies_of_week,
    similarity_matrix,
    similar_movies,
    similar_movies_from_vectors,
    content_features,
    updated_features,
    content_similarity,
    realtime_recommend,
    session_aggregate,
    session_filter,
    actions_in_range,
    session_length_stats,
    top10_categories,
    top_sessions_of_category,
    top_session_details,
    page_transitions,
    page_convert_rate,
    top_movies_of_area,
    parsed_log_events,
    mixed_log_events,
    rejected_log_lines,
    uv_exact,
    uv_bitmap,
    uv_approx,
    late_rows,
    hot_movies_window,
    login_fail_detect,
    current_locks,
)


def _streamed(spark: SparkSession, name: str, start: Callable[[str, str], StreamingQuery]) -> DataFrame:
    """Run a stream over everything available and return the table it wrote."""
    place = scratch_path(spark, name)
    table = f"{place}/table"
    start(table, f"{place}/checkpoint").awaitTermination()
    return spark.read.parquet(table)


# Allowed disorder of the streams that hold nothing back.
DELAY_MS = 120_000


def uv_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Exact visitors of the closed hours, as they were reported."""
    place = scratch_path(spark, "uv")
    events = StreamedDomain(spark, folder).log_events
    stream_visitors.start_visitor_counts(events, place, f"{place}/checkpoint", DELAY_MS, 0).awaitTermination()
    return stream_visitors.reported_counts(spark, place)


def uv_stream_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    """Bitmap count of every hour, from stored blocks that arrivals are merged into."""
    place = scratch_path(spark, "uv-bitmap")

    # Nothing is too late here: the batch count has all rows.
    def start(events: DataFrame) -> StreamingQuery:
        return stream_visitors.start_visitor_bitmaps(events, place, f"{place}/checkpoint", DELAY_MS, 100 * stream_late.DAY_MS)

    _in_arrivals(spark, folder, "uv-bitmap-arrived", start)
    return stream_visitors.running_counts(spark, place)


def hot_movies_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Rankings of the closed windows."""
    events = StreamedDomain(spark, folder).log_events
    steps, progress = scratch_path(spark, "hot-steps"), scratch_path(spark, "hot-progress")
    ranked = _streamed(
        spark,
        "hot",
        lambda table, state: stream_hot.start_hot_movies(events, table, steps, progress, state),
    )
    return ranked.drop("batch_id")


def login_fail_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Warnings up to the newest event."""
    events = StreamedDomain(spark, folder).logins
    places = [scratch_path(spark, f"logins-{name}") for name in ("late", "events", "state")]
    warnings = _streamed(
        spark,
        "logins",
        lambda table, state: stream_logins.start_login_fails(
            events, table, *places, state, LOGIN_GAP_MS, tie=("event_id",)
        ),
    )
    return warnings.drop("batch_id")


def lock_table_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The current lock of every user, kept by a stream of warnings that arrive in two files or more."""
    arrived = scratch_path(spark, "warnings")
    login_fail_detect(Domain(spark, folder)).repartition(2).write.parquet(arrived)
    stored = spark.read.parquet(arrived)
    reader = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1)
    locks = _streamed(
        spark,
        "locks",
        lambda table, state: stream_logins.start_lock_table(reader.parquet(arrived), table, state),
    )
    return locks.drop("part")


def recommend_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Recommendations for the newest rating of each user, arriving as text lines."""
    d = Domain(spark, folder)
    arrived = scratch_path(spark, "rating-lines")
    fields = [F.col("uid").cast("string"), F.col("mid").cast("string"), F.lit("80"), F.lit(AS_OF)]
    with shuffles_dropped(spark):
        newest_ratings(d).select(F.concat_ws("|", *fields).alias("value")).write.text(arrived)
    events = lines.parse_ratings(streams.file_lines(spark, arrived))
    schema = "uid long, mid long, rating double, date string, l_orderkey long, l_linenumber int, l_suppkey long"
    store, index = RatingStore(spark, scratch_path(spark, "ratings"), schema), _index(d)
    store.create(d.ratings)
    found = _streamed(
        spark,
        "recommend",
        lambda table, state: stream_recommend.start_recommendations(
            events,
            store,
            index,
            lambda: d.movies,
            table,
            state,
            AS_OF,
            interval=None,
            tie=Domain.RATING_TIE,
        ),
    )
    return found.drop("batch_id").withColumn("score", F.round("score", 4))


# Arrivals of the streams that come in several.
ARRIVALS = 4


def _in_arrivals(
    spark: SparkSession, folder: str, name: str, start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Run a stream over log events that arrive in four quarters of time, and stop it after each.

    Every 97th row is held back until the last quarter, so that it comes late.
    """
    logged = saved(Domain(spark, folder).arriving_log_events(ARRIVALS))
    arrived = scratch_path(spark, name)
    for number in range(ARRIVALS):
        part = logged.where(F.col("arrival") == number).drop("arrival")
        part.write.mode("append").parquet(arrived)
        start(spark.readStream.schema(part.schema).parquet(arrived)).awaitTermination()


def _split_stream(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """On-time and late rows of the arriving log events."""
    place = scratch_path(spark, "uv-split")
    paths = [f"{place}/{name}" for name in ("on-time", "late", "state", "checkpoint")]
    _in_arrivals(spark, folder, "uv-split-arrived", lambda events: stream_late.start_late_split(events, *paths))
    return spark.read.parquet(f"{place}/on-time"), spark.read.parquet(f"{place}/late")


def uv_running_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The running count of every hour after four arrivals, of which the last brings late rows."""
    place = scratch_path(spark, "uv-running")

    def start(events: DataFrame) -> StreamingQuery:
        return stream_visitors.start_visitor_counts(events, place, f"{place}/checkpoint")

    _in_arrivals(spark, folder, "uv-running-arrived", start)
    return stream_visitors.running_counts(spark, place)


# Allowed lateness of the corrected counts.
CORRECTED_MS = 10 * stream_late.DAY_MS


def uv_corrected_stream(spark: SparkSession, folder: str) -> DataFrame:
    """What was last reported of every closed hour, where rows of the last ten days correct it."""
    place = scratch_path(spark, "uv-corrected")

    def start(events: DataFrame) -> StreamingQuery:
        return stream_visitors.start_visitor_counts(
            events, place, f"{place}/checkpoint", stream_late.DELAY_MS, CORRECTED_MS
        )

    _in_arrivals(spark, folder, "uv-corrected-arrived", start)
    return stream_visitors.reported_counts(spark, place)


def uv_on_time_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Exact visitors of every hour from the rows that came in time."""
    return stream_late.recount(_split_stream(spark, folder)[0].drop("batch_id"))


def uv_late_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that came after their hour had closed."""
    return _split_stream(spark, folder)[1].select("uid", "ip", "mid", "event", "timestamp")


_STREAMS = (
    uv_on_time_stream,
    uv_late_stream,
    uv_running_stream,
    uv_corrected_stream,
    uv_stream,
    uv_stream_bitmap,
    hot_movies_stream,
    login_fail_stream,
    lock_table_stream,
    recommend_stream,
)


def _bound(job: Callable[[Domain], DataFrame]) -> Query:
    return lambda spark, folder: job(Domain(spark, folder))


def queries() -> dict[str, Query]:
    batch = {job.__name__: _bound(job) for job in _BATCH}
    return batch | {job.__name__: job for job in _STREAMS}
