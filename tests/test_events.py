from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reelstat import schemas
from reelstat.functions.hashing import bitmap_offset
from reelstat.operators import hot_movies, logins, visitors
from reelstat.sources import lines, streams, tables


def ms(text):
    return int(dt.datetime.fromisoformat(f"2024-01-01T{text}+00:00").timestamp() * 1000)


@pytest.fixture
def text(table):
    return lambda *values: table([(v,) for v in values], "value string")


def test_rating_line(text):
    assert rows(lines.parse_ratings(text("2774532135|1765009|80|2017-03-14"))) == [
        (2774532135, 1765009, 80.0, "2017-03-14")
    ]


def test_malformed_lines(text):
    given = text(
        "1|a||play|1000", "1|a|5|play", "x|a|5|play|1000", "1|a|5|play|1000|more", "", "|a|5|play|7", '1|"a|5|play|8'
    )
    assert rows(lines.parse_log_events(given)) == sorted(
        [(1, "a", None, "play", 1000), (None, "a", 5, "play", 7), (1, '"a', 5, "play", 8)], key=repr
    )
    assert rows(lines.parse_plays(given), "mid", "timestamp") == [(5, 7), (5, 8)]
    assert rows(lines.rejected_lines(given, schemas.LOG_LINE)) == [
        ("",), ("1|a|5|play",), ("1|a|5|play|1000|more",), ("x|a|5|play|1000",)
    ]


def test_login_lines(text):
    assert rows(lines.parse_logins(text("1|a|fail|5", "|a|fail|5"))) == [(1, "a", "fail", 5)]


def test_conform(table):
    given = table([("1", "x", "2.5", "d", "e")], "uid string, mid string, rating string, date string, rating_id string")
    assert rows(tables.conform(given, schemas.RATINGS)) == [(None, 1, None, 2.5, "d")]
    with pytest.raises(ValueError, match="rating_id"):
        tables.conform(given.drop("rating_id"), schemas.RATINGS)


def test_reader_options():
    options = tables.jdbc_options("jdbc:x", "m_rating", "rating_id", (1, 9), 4)
    assert options["partitionColumn"] == "rating_id" and options["numPartitions"] == "4"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "m_rating", "rating_id")
    assert streams.kafka_options("h:1", "event", per_trigger=5)["maxOffsetsPerTrigger"] == "5"


def test_read_parquet_and_table(spark, table, tmp_path):
    table([(1, 2, 3, 4.0, "d", "extra")], "rating_id long, uid long, mid long, rating double, date string, x string").write.parquet(str(tmp_path / "r"))
    assert tables.read_parquet(spark, str(tmp_path / "r"), schemas.RATINGS).columns == schemas.RATINGS.fieldNames()
    spark.read.parquet(str(tmp_path / "r")).createOrReplaceTempView("m_rating")
    assert rows(tables.read_table(spark, "m_rating", schemas.RATINGS)) == [(1, 2, 3, 4.0, "d")]


def test_hash(table):
    [(value,)] = rows(table([("1110.0.0.1",)], "s string").select(bitmap_offset(F.col("s"))))
    expected = 0
    for char in "1110.0.0.1":
        expected = expected * 61 + ord(char)
    assert value == expected & (2**23 - 1)


@pytest.mark.parametrize("method", ["exact", "approx", "bitmap"])
def test_visitors_and_hour_labels(table, method):
    events = table(
        [(1, "a", ms("09:10:00")), (1, "a", ms("09:59:59")), (1, "b", ms("19:00:00")), (2, "a", ms("23:00:00"))],
        "uid long, ip string, timestamp long",
    )
    assert rows(visitors.uv_count(events, method)) == [
        ("2024-01-01-09", "2024-01-01-10", 1),
        ("2024-01-01-19", "2024-01-01-20", 1),
        ("2024-01-01-23", "2024-01-02-00", 1),
    ]


def test_unknown_method(table):
    with pytest.raises(ValueError):
        visitors.uv_count(table([(1, "a", 1)], "uid long, ip string, timestamp long"), "guess")


PLAY = "uid long, mid long, event string, timestamp long"


def window_counts(entries, size, slide):
    seen = set()
    for uid, mid, event, time in entries:
        if event == "play" and mid is not None:
            last = time // slide
            seen |= {(mid, start * slide + size, uid) for start in range(last - size // slide + 1, last + 1)}
    counts = {}
    for mid, end, _ in seen:
        counts[mid, end] = counts.get((mid, end), 0) + 1
    return counts


def test_one_play_is_in_twelve_windows(table):
    events = table([(1, 5, "play", ms("12:00:00")), (1, 5, "play", ms("12:00:30")), (1, 6, "fav", 1), (1, None, "play", 1)], PLAY)
    found = hot_movies.window_viewers(events).collect()
    assert len(found) == 12 and {r["count"] for r in found} == {1}
    with pytest.raises(ValueError):
        hot_movies.window_viewers(events, 1000, 300)


def test_windows_equal_brute_force_with_a_hot_user_and_movie(table):
    pick = random.Random(5)
    entries = [
        (0 if pick.random() < 0.4 else pick.randrange(1, 30), 0 if pick.random() < 0.4 else pick.randrange(1, 15), "play", pick.randrange(0, 40_000))
        for _ in range(1500)
    ]
    found = {(r.mid, r.windowEnd): r["count"] for r in hot_movies.window_viewers(table(entries, PLAY), 3000, 500).collect()}
    assert found == window_counts(entries, 3000, 500)
    best = hot_movies.hot_movies_window(table(entries, PLAY), 3000, 500, n=3).collect()
    groups = {}
    for (mid, end), count in window_counts(entries, 3000, 500).items():
        groups.setdefault(end, []).append((-count, mid))
    expected = {(end, i + 1, mid) for end, g in groups.items() for i, (_, mid) in enumerate(sorted(g)[:3])}
    assert {(r.windowEnd, r["rank"], r.mid) for r in best} == expected


LOGIN = "uid long, eventType string, timestamp long"


def warned(table, *entries, **options):
    frame = logins.login_fail_detect(table(list(entries), LOGIN), **options)
    return rows(frame, "uid", "time", "no_login_time")


def test_failures_in_direct_succession(table):
    assert warned(table, (1, "fail", 1000), (1, "fail", 2900)) == [(1, "1000", 1000 + 1_800_000)]
    assert warned(table, (1, "fail", 1000), (1, "success", 1500), (1, "fail", 2000)) == []
    assert warned(table, (1, "fail", 1000), (1, "fail", 3000)) == []
    assert warned(table, (1, "fail", 1000), (2, "fail", 1500)) == []
    assert len(warned(table, (1, "fail", 1000), (1, "fail", 1500), (1, "fail", 2000))) == 2
    assert len(warned(table, (1, "fail", 1500), (1, "fail", 1000))) == 1


def test_failures_across_time_pieces_of_an_attacked_account(table):
    pick = random.Random(9)
    entries = [
        (0 if pick.random() < 0.5 else pick.randrange(1, 6), pick.choice(["fail", "success", "fail"]), t)
        for t in pick.sample(range(60_000), 1200)
    ]
    expected = []
    for uid in range(6):
        mine = sorted(e[1:][::-1] for e in entries if e[0] == uid)
        expected += [
            (uid, str(a[0]), a[0] + 1_800_000)
            for a, b in zip(mine, mine[1:])
            if a[1] == b[1] == "fail" and b[0] - a[0] < 150
        ]
    for piece in (1, 150, 700, 10_000_000):
        assert warned(table, *entries, within_ms=150, piece_ms=piece) == sorted(expected, key=repr)


def test_current_locks_keep_the_latest(table):
    frame = logins.login_fail_detect(
        table([(1, "fail", 0), (1, "fail", 1), (1, "fail", 2)], LOGIN), lock_minutes=30
    )
    assert rows(logins.current_locks(frame)) == [(1, 1 + 1_800_000)]
