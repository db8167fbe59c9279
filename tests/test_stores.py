"""Stored tables that spare work: clustered actions and kept-up features."""

from __future__ import annotations

import pathlib
import random

import pyarrow.parquet as pq
import pytest
from conftest import rows

from reelstat import schemas
from reelstat.operators import content
from reelstat.operators.feature_store import FeatureStore
from reelstat.sources import action_table, streams


def groups(path, column, low, high):
    """Row groups of the files under a path, and those of which a range of a column may hold rows."""
    total = hit = 0
    for file in pathlib.Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = next(k for k in range(meta.num_columns) if meta.schema.column(k).path == column)
        for k in range(meta.num_row_groups):
            ends = meta.row_group(k).column(at).statistics
            total += 1
            hit += ends.max >= low and ends.min <= high
    return total, hit


@pytest.fixture
def stored(spark, tmp_path):
    """20,000 actions of 500 users over 30 days, a tenth of them of one session."""
    pick = random.Random(6)
    data = []
    for k in range(20_000):
        date = pick.randrange(30 * 86_400_000)
        session = "00042-hot" if k % 10 == 0 else f"{pick.randrange(500):05d}-{date // 86_400_000:02d}"
        data.append((date, k, session if k else None, "index"))
    frame = spark.createDataFrame(data, "date long, userId long, sessionId string, pageId string")
    path = str(tmp_path / "actions")
    action_table.write_actions(frame, path, files=64, group_bytes=1 << 14)
    return frame, path


def test_ranges_of_either_key_leave_row_groups_out(spark, stored):
    frame, path = stored
    read = action_table.read_actions(spark, path)
    assert rows(read) == rows(frame)
    day = 86_400_000
    total, hit = groups(path, "date", 3 * day, 5 * day)
    assert total >= 60 and hit < 0.4 * total
    total, hit = groups(path, "sessionId", "00300-", "00320-")
    assert hit < 0.4 * total
    few = read.where(f"date between {3 * day} and {5 * day}")
    assert few.count() == frame.where(f"date between {3 * day} and {5 * day}").count()
    assert "GreaterThanOrEqual(date" in few._jdf.queryExecution().executedPlan().toString()


def test_a_crowded_session_is_spread_over_files(stored):
    _, path = stored
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in pathlib.Path(path).glob("*.parquet")]
    assert max(sizes) < 5 * sum(sizes) / len(sizes)


def test_actions_without_a_range(spark, tmp_path):
    schema = "date long, sessionId string"
    for name, data in (("none", []), ("one", [(5, "s")] * 3), ("null", [(None, None), (1, "a")])):
        action_table.write_actions(spark.createDataFrame(data, schema), str(tmp_path / name))
        assert rows(action_table.read_actions(spark, str(tmp_path / name))) == sorted(data, key=repr)


MOVIES = (
    "mid long, movie_name string, img_urls string, directors string, main_actors string, "
    "categories string, language string, location string"
)


def movie(mid, seed=0):
    pick = random.Random(f"{mid} {seed}")
    word = lambda n: f"w{pick.randrange(n)}"
    return (mid, "n", "i", word(300), f"{word(300)}|{word(300)}", f"{word(9)}|{word(9)}", word(4), word(12))


def vectors(frame):
    return {r.mid: pytest.approx(list(r.vector), abs=1e-12) for r in frame.collect()}


def test_features_follow_inserts_changes_and_deletes(spark, table, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "f"), num_features=64, parts=8)
    assert store.features().count() == 0
    states = [
        [movie(m) for m in range(1, 80)],
        [movie(m, seed=int(m % 10 == 0)) for m in range(1, 90)],  # eight changes, ten new ones
        [movie(m, seed=int(m % 10 == 0)) for m in range(1, 90) if m % 3],  # a third goes
        [movie(500)],
        [],
    ]
    read = []
    for state in states:
        movies = table(state, MOVIES)
        read.append(store.update(movies))
        assert store.update(movies) == 0
        found = {r.mid: list(r.vector) for r in store.features().collect()}
        wanted = vectors(content.content_features(movies, 64)) if state else {}
        assert found == wanted
    assert read == [79, 7 + 10, 0, 1, 0]


def test_an_interrupted_update_is_repaired(spark, table, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "f"), num_features=64, parts=4)
    first = table([movie(m) for m in range(20)], MOVIES)
    store.update(first)
    # The frequencies of an update did not get written: its movies count as changed no more, so write them anew.
    store._replace("frequencies", store._read("frequencies", "at int, movies long, part int").where("part < 2"), list(range(4)))
    changed = table([movie(m, seed=1) for m in range(20)], MOVIES)
    store.update(changed)
    found = {r.mid: list(r.vector) for r in store.features().collect()}
    assert found == vectors(content.content_features(changed, 64))


def test_event_time_sets_a_watermark(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1000)], "uid long, ip string, timestamp long").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("uid long, ip string, timestamp long").parquet(str(tmp_path / "e"))
    timed = streams.event_time(stream, "2 minutes")
    assert "EventTimeWatermark" in timed._jdf.queryExecution().analyzed().toString()
    assert dict(timed.dtypes)["ts"] == "timestamp" and schemas.ACTIONS
