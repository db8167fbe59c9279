"""Every registered query against its SQL form on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tools.check_queries import compare, connect

FOLDER = entry.SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    if name not in ORACLES:
        assert frame.count() > 0
        return
    result = compare(frame, con, ORACLES[name])
    assert result.startswith("ok"), result


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_approximate_visitors_are_close(spark):
    rows = QUERIES["uv_approx"](spark, FOLDER).collect()
    hours = {(r.startTime, r.endTime) for r in QUERIES["uv_exact"](spark, FOLDER).collect()}
    assert {(r.startTime, r.endTime) for r in rows} == hours
    assert all(r.close for r in rows)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 10
