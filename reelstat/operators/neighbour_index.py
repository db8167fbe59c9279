"""A stored index of movie vectors: similar movies of some movies, without comparing them with the whole catalogue.

Every movie is grouped with its nearest centre. A centre is stored with the widest angle to one of its movies, so that
the angle from an asked movie to the centre bounds the cosine of every movie of the group. A search visits

1. the groups around the asked movie that hold enough movies for its list, which gives the score its list ends with, and
2. of all other groups those whose bound reaches that score, which none can miss.

Asked movies and members meet in blocks that a task reads where they are stored, and a task keeps the best of each asked
movie over all members that it reads: neither a visit nor a list of a group is ever shuffled.

The result is exact. How many groups the bound leaves out depends on the vectors: all but a few where movies form clusters,
hardly any where their directions are spread evenly.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelstat.functions import ranking
from reelstat.operators import crossing
from reelstat.operators.crossing import Best
from reelstat.operators.similarity import DECIMALS
from reelstat.session import saved

# Centres at most; they are the only part of an index that is held as a whole.
MAX_CENTRES = 2048
# Movies of a part of a group.
PART = 4096
# Asked movies of a block, places of their lists, and members of a block; they bound the memory of a task.
ASKED, PLACES, HELD = 1024, 1 << 20, 8192
# Movies that the first round should find for each place of a list.
AHEAD = 2
# Added to a bound against rounding.
SLACK = 1e-9

MEMBER = "group int, part int, mid long, unit array<double>"
CENTRE = "group int, centre array<double>, size long, parts int, angle double"
_FOUND = "mid long, mid2 long, score double"


class Centres(NamedTuple):
    """The centres of an index as arrays; at most MAX_CENTRES rows."""

    group: np.ndarray
    centre: np.ndarray
    size: np.ndarray
    parts: np.ndarray
    angle: np.ndarray


def _rows(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def _lists(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.ravel()))


def directions(vectors: DataFrame) -> DataFrame:
    """(mid, unit) of the vectors that have a direction: none of zeros, nulls or numbers that are not finite."""
    vector = F.col("vector").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    top = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    kept = vectors.where(F.coalesce(fine, F.lit(False)) & (top > 0)).select("mid", vector.alias("vector"))

    def unit(batches):
        for batch in batches:
            rows = _rows(batch.column(1))
            if len(rows):
                rows = rows / np.linalg.norm(rows, axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(rows)], names=["mid", "unit"])

    return kept.mapInArrow(unit, "mid long, unit array<double>")


def _assign(centres: np.ndarray):
    def assign(batches):
        for batch in batches:
            rows = _rows(batch.column(1))
            if not len(rows):
                continue
            cosine = rows @ centres.T
            group = cosine.argmax(axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(rows)), group], -1, 1))
            columns = [pa.array(group.astype(np.int32)), batch.column(0), batch.column(1), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(columns, names=["group", "mid", "unit", "angle"])

    return assign


def build(vectors: DataFrame, path: str, centres: int | None = None) -> None:
    """Write the index of (mid, vector) rows, all of one length, under ``path``.

    Centres are movies picked by the hash of their id, about the root of the number of movies and at most MAX_CENTRES.
    """
    spark = vectors.sparkSession
    units = saved(directions(vectors))
    count = units.count()
    wanted = min(MAX_CENTRES, centres or max(1, round(math.sqrt(count))))
    picked = units.orderBy(F.xxhash64("mid"), "mid").limit(wanted).select("unit").toArrow()
    middle = _rows(picked.column("unit").combine_chunks())
    middle = np.unique(middle, axis=0) if len(middle) else middle
    assigned = units.mapInArrow(_assign(middle), "group int, mid long, unit array<double>, angle double")
    assigned = saved(assigned)
    sizes = assigned.groupBy("group").agg(F.count("*").alias("size"), F.max("angle").alias("angle"))
    parts = F.ceil(F.col("size") / PART).cast("int")
    table = [(k, row.tolist()) for k, row in enumerate(middle)]
    frame = spark.createDataFrame(table, "group int, centre array<double>")
    described = saved(frame.join(sizes, "group").select("group", "centre", "size", parts.alias("parts"), "angle"))
    described.write.parquet(f"{path}/centres")
    part = F.pmod(F.xxhash64("mid"), F.col("parts")).cast("int").alias("part")
    members = assigned.drop("angle").join(F.broadcast(described.select("group", "parts")), "group")
    members = members.select("group", part, "mid", "unit")
    # In the order of groups, so that a read of some of them leaves row groups out.
    members.repartitionByRange("group", "part", "mid").sortWithinPartitions("group", "part").write.parquet(f"{path}/members")


def centres(spark: SparkSession, path: str) -> Centres:
    rows = spark.read.schema(CENTRE).parquet(f"{path}/centres").orderBy("group").toArrow()
    number = lambda name: rows.column(name).to_numpy()
    return Centres(
        number("group"), _rows(rows.column("centre").combine_chunks()), number("size"), number("parts"), number("angle")
    )


def _bounds(units: np.ndarray, index: Centres) -> np.ndarray:
    """The greatest cosine that a movie of each group may have with each row."""
    to_centre = np.arccos(np.clip(units @ index.centre.T, -1, 1))
    return np.cos(np.maximum(0, to_centre - index.angle)) + SLACK


def _first(bounds: np.ndarray, depth: np.ndarray, index: Centres) -> np.ndarray:
    """Which groups the first round visits: the best bounds, until they hold AHEAD movies for each place."""
    order = np.argsort(-bounds, axis=1, kind="stable")
    held = np.cumsum(index.size[order], axis=1)
    before = held - index.size[order]
    chosen = np.zeros(bounds.shape, bool)
    np.put_along_axis(chosen, order, before < (AHEAD * depth[:, None] + 1), axis=1)
    return chosen


def _visiting(index: Centres, again: bool):
    """From (mid, depth, unit, floor) to the parts of groups that a round visits for each."""

    def visiting(batches):
        for batch in batches:
            units = _rows(batch.column(2))
            if not len(units):
                continue
            depth = batch.column(1).to_numpy().astype(np.int64)
            bounds = _bounds(units, index)
            chosen = _first(bounds, depth, index)
            if again:
                chosen = ~chosen & (bounds >= batch.column(3).to_numpy()[:, None])
            row, group = np.nonzero(chosen)
            parts = index.parts[group].astype(np.int64)
            row, group = np.repeat(row, parts), np.repeat(group, parts)
            part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            own = batch.take(pa.array(row))
            columns = [pa.array(index.group[group].astype(np.int32)), pa.array(part.astype(np.int32)), *own.columns]
            yield pa.RecordBatch.from_arrays(columns, names=["group", "part", "mid", "depth", "unit", "floor"])

    return visiting


def visits(asked: DataFrame, index: Centres, again: bool) -> DataFrame:
    """The (group, part) pairs that a round visits for each asked (mid, depth, unit, floor)."""
    needed = asked.select("mid", "depth", "unit", "floor")
    return needed.mapInArrow(_visiting(index, again), "group int, part int, mid long, depth long, unit array<double>, floor double")


def _asked_blocks(batches):
    """(block, rows): the asked movies of a partition, of which those of like depths share a block."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).sort_by([("depth", "ascending"), ("mid", "ascending")])
    depth, start = table.column("depth").to_numpy(), 0
    while start < len(depth):
        ends = np.arange(start + 1, min(start + ASKED, len(depth)) + 1)
        stop = int(ends[max(np.searchsorted(depth[ends - 1] * (ends - start), PLACES, side="right") - 1, 0)])
        rows = crossing.packed(table.slice(start, stop - start))
        start = stop
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.binary())], names=["rows"])


def _member_blocks(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, HELD):
            rows = crossing.packed(pa.Table.from_batches([batch.slice(start, HELD)]))
            yield pa.RecordBatch.from_arrays([pa.array([rows], pa.binary())], names=["others"])


def _meet(rows: np.ndarray, mine: np.ndarray, names: np.ndarray, other: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Add to ``best`` what the given rows of the asked movies find among the members of a group."""
    for start in range(0, len(rows), 512):
        some = rows[start : start + 512]
        scores = mine[some] @ other.T
        row, column = np.nonzero(scores >= best.floor[some, None] - SLACK)
        scores = np.round(scores[row, column], DECIMALS)
        row = some[row]
        wanted = (names[row] != ids[column]) & (scores != 0) & (scores >= best.floor[row])
        if wanted.any():
            best.add(row[wanted], ids[column[wanted]], scores[wanted])


def _searching(index: Centres):
    """From (block, rows, others) to the best ``depth`` movies of each asked movie among the members that a task reads."""

    def search(asked: pa.Table, members: pa.Table) -> pa.RecordBatch:
        names, depth = asked.column("mid").to_numpy(), asked.column("depth").to_numpy()
        mine = _rows(asked.column("unit").chunk(0))
        members = members.sort_by([("group", "ascending"), ("mid", "ascending")]).combine_chunks()
        group, ids = members.column("group").to_numpy(), members.column("mid").to_numpy()
        other = _rows(members.column("unit").chunk(0))
        bounds, best = _bounds(mine, index), Best(depth)
        first = _first(bounds, depth, index)
        known, starts = np.unique(group, return_index=True)
        column = np.searchsorted(index.group, known)
        ends = [*starts[1:], len(group)]
        for again in (False, True):
            for k, start, stop in zip(column, starts, ends):
                chosen = ~first[:, k] & (bounds[:, k] >= best.floor) if again else first[:, k]
                _meet(np.flatnonzero(chosen), mine, names, other[start:stop], ids[start:stop], best)
            best.merge()
        row, mid, score = best.found()
        return pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(mid), pa.array(score)], names=["mid", "mid2", "score"])

    def searching(batches):
        current, rows, held = None, None, []
        for batch in batches:
            for number in range(batch.num_rows):
                block = batch.column(0)[number].as_py()
                if block != current:
                    if held:
                        yield search(crossing.unpacked(rows), pa.concat_tables(held))
                    current, rows, held = block, batch.column(1)[number].as_py(), []
                held.append(crossing.unpacked(batch.column(2)[number].as_buffer()))
        if held:
            yield search(crossing.unpacked(rows), pa.concat_tables(held))

    return searching


def search(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """For each asked movie (mid, depth) its ``depth`` most similar movies, as (mid, mid2, score, place).

    A movie without a direction has no similar ones; pairs with cosine 0 are left out. Equal scores go to the lower id.
    """
    index = centres(spark, path)
    members = spark.read.schema(MEMBER).parquet(f"{path}/members").where("mid is not null")
    start = saved(members.join(asked.select("mid", F.col("depth").cast("long").alias("depth")), "mid").select("mid", "depth", "unit"))
    count = start.count()
    blocks = max(1, math.ceil(count / ASKED))
    dealt = start.repartitionByRange(blocks, "depth", "mid").mapInArrow(_asked_blocks, "rows binary")
    one = saved(dealt.withColumn("block", F.monotonically_increasing_id()))
    kept = members.select("group", "mid", "unit").mapInArrow(_member_blocks, "others binary")
    total = int(index.size.sum())
    size = 8 * total * (index.centre.shape[1] if index.centre.ndim == 2 else 0)
    parts = crossing.width(blocks, max(1, math.ceil(total / HELD)), size, spark.sparkContext.defaultParallelism)
    two = saved(kept.repartition(parts))
    met = crossing.crossed(one, two, F.lit(True)).select("block", "rows", "others")
    found = saved(met.mapInArrow(_searching(index), _FOUND))
    # Lists of several tasks are merged.
    order = [F.desc("score"), F.asc("mid2")]
    return ranking.placed(found.join(start.select("mid", "depth"), "mid"), ["mid"], order, "place", F.col("depth")).drop("depth")
