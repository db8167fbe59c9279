from __future__ import annotations

import datetime as dt
import math
import os

import pytest
from conftest import rows

from reelstat.operators import (
    hot_movies as batch_hot,
    logins as batch_logins,
    neighbour_index,
)
from reelstat.sinks.tables import write_batch
from reelstat.sources import lines, streams
from reelstat.sources.rating_store import RatingStore
from reelstat.streaming import hot_movies, late, logins, recommend, run, visitors


def ms(text):
    return int(dt.datetime.fromisoformat(f"2024-01-01T{text}+00:00").timestamp() * 1000)


class Feed:
    """A folder of text files read as a stream, one file per micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = spark, folder, 0
        folder.mkdir()

    def add(self, *entries):
        self.count += 1
        path = self.folder / f"{self.count:03d}.txt"
        path.write_text("".join("|".join(map(str, e)) + "\n" for e in entries), encoding="utf-8")
        os.utime(path, (1_700_000_000 + self.count, 1_700_000_000 + self.count))

    def lines(self):
        return streams.file_lines(self.spark, str(self.folder), files_per_trigger=1)

    def stored(self):
        return self.spark.read.text(str(self.folder))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive


@pytest.mark.parametrize(
    "batches, on_time, late_ones",
    [
        ([[(1, "00:05:00"), (2, "01:10:00")], [(3, "00:59:00")], [(4, "00:50:00"), (5, "03:20:00")]], [1, 2, 5], [3, 4]),
        ([[(1, "01:01:59")], [(2, "00:59:00")]], [1, 2], []),
        ([[(1, "01:02:00")], [(2, "00:59:00")]], [1], [2]),
    ],
)
def test_late_rows_go_to_their_own_table(spark, feed, tmp_path, batches, on_time, late_ones):
    for batch in batches:
        feed.add(*[(uid, "ip", 7, "play", ms(time)) for uid, time in batch])
    events = lines.parse_log_events(feed.lines())
    paths = [str(tmp_path / name) for name in ("on", "late", "state", "check")]
    finish(late.start_late_split(events, *paths))
    assert [r.uid for r in spark.read.parquet(paths[0]).orderBy("uid").collect()] == on_time
    assert [r.uid for r in spark.read.parquet(paths[1]).orderBy("uid").collect()] == late_ones

    stored = spark.read.parquet(paths[0])
    counts = late.recount(stored, since=ms("01:00:00"))
    hours = [time[:2] for batch in batches for uid, time in batch if uid in on_time]
    expected = {h: hours.count(h) for h in set(hours) if h >= "01"}
    assert {r.startTime[-2:]: r["count"] for r in counts.collect()} == expected
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(hour" in plan

    # A later run continues from the stored event time.
    feed.add((9, "ip", 7, "play", ms("00:30:00")))
    finish(late.start_late_split(events, *paths))
    assert (9 in [r.uid for r in spark.read.parquet(paths[1]).collect()]) == bool(late_ones)


def test_repeated_batch_replaces_its_rows(spark, table, tmp_path):
    path = str(tmp_path / "out")
    write_batch(table([(1,), (2,)], "v int"), 0, path)
    write_batch(table([(3,)], "v int"), 1, path)
    write_batch(table([(3,)], "v int"), 1, path)
    assert rows(spark.read.parquet(path), "v") == [(1,), (2,), (3,)]


STARTS = {"counts": visitors.start_visitor_counts, "bitmaps": visitors.start_visitor_bitmaps}


@pytest.mark.parametrize("kind", STARTS)
def test_counts_run_close_and_are_corrected(spark, feed, tmp_path, kind):
    """Delay 1 minute, allowed lateness 2 hours: rows of 08 may come until 11:01."""
    place, state = str(tmp_path / "uv"), str(tmp_path / "c")
    start = lambda: finish(STARTS[kind](lines.parse_log_events(feed.lines()), place, state, 60_000, 2 * 3_600_000))
    running = lambda: {r.startTime[-2:]: r["count"] for r in visitors.running_counts(spark, place).collect()}
    reports = lambda: [
        (r.batch_id, r.hour // 3_600_000 % 24, r["count"], r.correction)
        for r in spark.read.schema(visitors.REPORTS).parquet(f"{place}/reports").orderBy("batch_id", "hour").collect()
    ]
    visits = lambda hour, uids: [(uid, f"10.0.0.{uid}", 1, "play", ms(f"{hour}:{uid % 60:02d}:00")) for uid in uids]
    feed.add(*visits("08", range(10)), *visits("08", range(10)), *visits("09", range(5)))
    start()
    assert running() == {"08": 10, "09": 5} and reports() == [(0, 8, 10, False)]
    # 08 gains two and is reported again; 09 closes; a repeated visitor changes nothing.
    feed.add(*visits("08", range(8, 12)), *visits("10", range(1, 4)))
    start()
    assert running() == {"08": 12, "09": 5, "10": 3}
    assert reports()[1:] == [(1, 8, 12, True), (1, 9, 5, False)]
    feed.add(*visits("11", [30]))
    start()
    # From now on rows of 08 are too late, those of 09 are not.
    feed.add(*visits("08", [40]), *visits("09", [50]))
    start()
    assert running() == {"08": 12, "09": 6, "10": 3, "11": 1}
    assert reports()[3:] == [(2, 10, 3, False), (3, 9, 6, True)]
    assert [r.uid for r in spark.read.parquet(f"{place}/late").collect()] == [40]
    final = {r.startTime[-2:]: r["count"] for r in visitors.reported_counts(spark, place).collect()}
    assert final == {"08": 12, "09": 6, "10": 3}
    if kind == "bitmaps":
        # Blocks of hours that are over have gone; one row for each hour and block is left.
        blocks = spark.read.schema(visitors.BLOCKS).parquet(f"{place}/blocks")
        assert {r.hour // 3_600_000 % 24 for r in blocks.collect()} == {9, 10, 11}
        assert blocks.groupBy("hour", "block").count().where("count > 1").count() == 0


@pytest.mark.parametrize("kind", STARTS)
def test_a_repeated_batch_counts_once(spark, table, tmp_path, kind, monkeypatch):
    steps = []
    monkeypatch.setattr(visitors, "to_batches", lambda events, write, *_, **__: steps.append(write))
    schema = "uid long, ip string, timestamp long"
    one = table([(u, "a", ms(f"08:{u:02d}:00")) for u in range(5)] + [(7, "a", ms("10:00:00"))], schema)
    two = table([(u, "a", ms(f"10:{u:02d}:00")) for u in range(4, 9)] + [(9, "a", ms("12:30:00"))], schema)
    STARTS[kind](one, str(tmp_path), "")
    for batch, number in ((one, 0), (one, 0), (two, 1), (two, 1), (two, 1)):
        steps[0](batch, number)
    found = {r.startTime[-2:]: r["count"] for r in visitors.running_counts(spark, str(tmp_path)).collect()}
    assert found == {"08": 5, "10": 5, "12": 1}
    assert rows(visitors.reported_counts(spark, str(tmp_path)), "startTime", "count") == [
        ("2024-01-01-08", 5), ("2024-01-01-10", 5)
    ]


def test_hot_movies_equal_the_batch_ranking(spark, feed, tmp_path):
    for start in ("12:00", "12:15", "12:30", "13:40", "16:20"):
        hour, minute = map(int, start.split(":"))
        feed.add(
            *[
                (n % 6, "ip", n % 4 or "", "play" if n % 5 else "fav", ms(f"{hour}:{minute + n % 15:02d}:0{n % 9}"))
                for n in range(40)
            ]
        )
    feed.add((1, "ip", 1, "play", ms("18:00:00")))
    feed.add((1, "ip", 1, "play", ms("18:10:00")), (2, "ip", 1, "play", ms("12:00:00")))
    paths = [str(tmp_path / name) for name in ("ranked", "steps", "state", "check")]
    finish(hot_movies.start_hot_movies(lines.parse_plays(feed.lines()), *paths, n=3))
    # The late play of 12:00 comes after its windows; the newest play of 18:10 closes what ends half a minute before.
    in_time = lines.parse_plays(feed.stored()).where(f"not (uid = 2 and timestamp = {ms('12:00:00')} and mid = 1)")
    expected = batch_hot.hot_movies_window(in_time, n=3).where(f"windowEnd <= {ms('18:09:30')}")
    columns = ("windowStart", "windowEnd", "mid", "count", "rank")
    found = spark.read.parquet(paths[0])
    assert rows(found, *columns) == rows(expected, *columns)
    assert found.select("batch_id").distinct().count() > 2


def test_all_windows_of_a_play_come_out_over_a_gap_of_hours(spark, feed, tmp_path):
    feed.add((1, "ip", 7, "play", ms("10:02:00")))
    feed.add((2, "ip", 8, "play", ms("15:00:00")))
    feed.add((2, "ip", 8, "play", ms("15:00:10")))
    paths = [str(tmp_path / name) for name in ("ranked", "steps", "state", "check")]
    finish(hot_movies.start_hot_movies(lines.parse_plays(feed.lines()), *paths))
    found = spark.read.parquet(paths[0]).where("mid = 7")
    ends = [(ms("10:05:00") + k * hot_movies.SLIDE_MS,) for k in range(12)]
    assert rows(found, "windowEnd") == ends
    # What is kept for open windows does not grow with the stream.
    kept = spark.read.parquet(f"{paths[1]}/turn=0")
    assert rows(kept.select("mid").distinct()) == [(8,)]


def test_login_stream_equals_the_batch(spark, feed, tmp_path):
    feed.add((1, "ip", "fail", 2000), (1, "ip", "fail", 1000), (2, "ip", "fail", 1500))
    feed.add((1, "ip", "fail", 2500), (2, "ip", "success", 2600), (2, "ip", "fail", 2700), (3, "ip", "fail", 2800))
    feed.add((3, "ip", "fail", 4000), (1, "ip", "success", 4100), (2, "ip", "fail", 4600), (4, "ip", "success", 9000))
    feed.add((3, "ip", "fail", 4100), (5, "ip", "fail", 9500))
    # A success in the millisecond of a failure comes after it.
    feed.add((6, "ip", "success", 9600), (6, "ip", "fail", 9600), (6, "ip", "fail", 9700))
    paths = [str(tmp_path / name) for name in ("warnings", "late", "events", "state", "check")]
    finish(logins.start_login_fails(lines.parse_logins(feed.lines()), *paths))
    found = spark.read.parquet(paths[0]).drop("batch_id")
    in_time = lines.parse_logins(feed.stored()).where("not (uid = 3 and timestamp = 4100)")
    assert rows(found) == rows(batch_logins.login_fail_detect(in_time))
    assert rows(found, "uid", "time") == [(1, "1000"), (1, "2000"), (2, "2700"), (3, "2800")]
    assert rows(spark.read.parquet(paths[1]), "uid", "timestamp") == [(3, 4100)]
    assert spark.read.parquet(f"{paths[2]}/turn=1").count() == 5


def test_lock_table_keeps_the_latest_lock(spark, table, tmp_path):
    path, schema = str(tmp_path / "locks"), "uid long, no_login_time long"
    logins.merge_locks(table([(1, 10), (1, 30), (2, 20)], schema), path)
    logins.merge_locks(table([(1, 25), (3, 40)], schema), path)
    logins.merge_locks(table([(1, 25), (3, 40)], schema), path)
    logins.merge_locks(table([], schema), path)
    logins.merge_locks(table([(2, 50)], schema), path)
    assert rows(spark.read.parquet(path), *schema.replace(" long", "").split(", ")) == [(1, 30), (2, 50), (3, 40)]


RATING = "uid long, mid long, rating double, date string"


def _recommending(spark, feed, table, tmp_path, history, keep):
    # Cosines: 1 and 3 0.4, 3 and 8 0.6, 2 and 3 0.1.
    vectors = table(
        [(1, [1.0, 0.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0, 0.0]), (3, [0.4, 0.1, 0.6, 0.47**0.5]), (8, [0.0, 0.0, 1.0, 0.0])],
        "mid long, vector array<double>",
    )
    neighbour_index.build(vectors, str(tmp_path / "index"))
    store = RatingStore(spark, str(tmp_path / "ratings"), RATING, parts=8)
    store.create(table(history, RATING))
    movies = table(
        [(3, "m", "i", 1.0, "c", 0)],
        "mid long, movie_name string, img_urls string, rating_num double, categories string, off_shelf int",
    )
    finish(
        recommend.start_recommendations(
            lines.parse_ratings(feed.lines()),
            store,
            str(tmp_path / "index"),
            lambda: movies,
            str(tmp_path / "o"),
            str(tmp_path / "c"),
            "2020-06-03",
            interval=None,
            keep=keep,
        )
    )
    return store, rows(spark.read.parquet(str(tmp_path / "o")), "batch_id", "uid", "rated_mid", "copy", "mid", "score")


def test_recommendation_stream(spark, feed, table, tmp_path):
    feed.add((20, 1, 80, "2017-03-14"), (20, 1, 80, "2017-03-14"))
    feed.add(("x", 1, 80, "2017-03-14"), (20, 2, 80, "2017-03-14"))
    history = [(20, m, 90.0, f"2020-01-{m:02d}") for m in (8, 9)]
    store, found = _recommending(spark, feed, table, tmp_path, history, keep=False)
    assert found == [(0, 20, 1, 1, 3, 54.0), (0, 20, 1, 2, 3, 54.0), (1, 20, 2, 1, 3, 54.0)]
    assert store.table().count() == 2


def test_a_stream_keeps_its_ratings(spark, feed, table, tmp_path):
    feed.add((20, 1, 80, "2020-03-14"))
    feed.add((20, 2, 80, "2020-03-15"), (21, 1, 10, "2020-03-15"))
    history = [(20, 8, 90.0, "2020-01-01")]
    store, found = _recommending(spark, feed, table, tmp_path, history, keep=True)
    # The newest rating is the event itself; 21 has rated nothing before, 20 movie 8 and then 1 too.
    assert found == [(0, 20, 1, 1, 3, 54.0), (1, 20, 2, 1, 3, pytest.approx((0.6 * 90 + 0.4 * 80) / 2 + math.log10(2)))]
    assert rows(store.table(), "uid", "mid") == [(20, 1), (20, 2), (20, 8), (21, 1)]
    store.append(table([(30, 5, 1.0, "2020-03-16")], RATING), 1)
    assert rows(store.table(), "uid", "mid") == [(20, 1), (20, 8), (30, 5)]


def test_the_rating_store_reads_the_parts_of_its_users(spark, table, tmp_path):
    store = RatingStore(spark, str(tmp_path / "r"), RATING, parts=16)
    store.create(table([(u % 100, u, 1.0, "2020-01-01") for u in range(1000)], RATING))
    few = store.of_users(table([(7,), (8,), (7,), (None,)], "uid long"))
    assert rows(few, "uid", "mid") == sorted(((u % 100, u) for u in range(1000) if u % 100 in (7, 8)), key=repr)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    parts = {r[0] for r in store.table().where("uid in (7, 8)").select("part").distinct().collect()}
    assert len(parts) <= 2 < store.table().select("part").distinct().count()
    assert store.of_users(table([], "uid long")).count() == 0


def test_console(feed, tmp_path):
    feed.add((1, "ip", 7, "play", 1))
    finish(run.to_console(lines.parse_log_events(feed.lines()), str(tmp_path / "c"), mode="append"))
