"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Each vector is filled up with zeros to ``SPREAD`` times its dimensions, turned by a fixed random rotation, and keeps one bit
per dimension, its length and a correction: the inner product of its direction with its code. For a query the packed
codes give an unbiased estimate of every inner product and a bound of its error, which falls with the root of the number
of bits. Within a block of candidates the best estimates are computed exactly first. Of the others, those whose upper bound
reaches the n-th exact score so far are reranked on the original vectors, piece by piece from the highest estimate on, and
the n-th score rises with every piece.

Queries and candidates meet in blocks of bounded size. A block hands on n rows for each query, which are merged.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from reelstat.llm.common import stored, table

NEAREST = 20
EVERY = 20
# Rows of a block of either side, and blocks of candidates at least.
CANDIDATE_BLOCK, QUERY_BLOCK, LEAST_BLOCKS = 1 << 15, 1 << 15, 16
# Bits of a code for each dimension.
SPREAD = 4
# Width of the error bound in units of its deviation; a true neighbour outside it may be missed.
WIDTH = 3.0
# Estimates held at once, and pairs reranked at once.
CELLS, PIECE = 1 << 20, 1 << 14

CODED = "vec_id long, code binary, length double, correction double, vector binary, dims int"
FOUND = "query_id long, vec_id long, score double"


@functools.cache
def rotation(dims: int) -> np.ndarray:
    """A random rotation of vectors that are filled up with zeros, the same in every task: its first ``dims`` rows."""
    bits = SPREAD * dims
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((bits, dims)))
    return (q * np.sign(np.diag(r))).T


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector as doubles; rows that are null, zero or not finite in any component are left out."""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .filter(F.coalesce(fine, F.lit(False)) & F.exists("vector", lambda x: x != 0))
    )


def _encode(batches):
    schema = pa.schema(
        [
            ("vec_id", pa.int64()),
            ("code", pa.binary()),
            ("length", pa.float64()),
            ("correction", pa.float64()),
            ("vector", pa.binary()),
            ("dims", pa.int32()),
        ]
    )
    for batch in batches:
        column = batch.column(1)
        sizes = np.asarray(column.value_lengths().fill_null(0))
        flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
        for dims in np.unique(sizes):
            rows = np.flatnonzero(sizes == dims)
            own = np.stack([flat[ends[r] - dims : ends[r]] for r in rows])
            # Scaled first, so that very large or small components stay finite.
            top = np.abs(own).max(axis=1, keepdims=True)
            length = np.linalg.norm(own / top, axis=1, keepdims=True) * top
            turned = (own / length) @ rotation(int(dims))
            bits = turned > 0
            correction = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
            codes = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(length[:, 0]),
                    pa.array(correction),
                    pa.array([v.astype("<f8").tobytes() for v in own], pa.binary()),
                    pa.array(np.full(len(rows), dims, np.int32)),
                ],
                schema=schema,
            )


def encode(vectors: DataFrame) -> DataFrame:
    """The index: code, length, correction and original vector of every usable row."""
    return usable(vectors).mapInArrow(_encode, CODED)


def _matrix(column: pa.ChunkedArray, type_: str) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), type_).reshape(len(values), -1)


def _exact(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in the order of the components, so that equal vectors tie exactly."""
    total = np.zeros(len(one))
    for d in range(one.shape[1]):
        total += one[:, d] * two[:, d]
    return total


class _Best:
    """The ``nearest`` pairs of each query found so far, and the score that another must reach."""

    def __init__(self, queries: int, nearest: int, ids: np.ndarray):
        self.nearest, self.ids = nearest, ids
        self.q = self.c = np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.floor = np.full(queries, -np.inf)

    def add(self, q: np.ndarray, c: np.ndarray, score: np.ndarray) -> None:
        good = score >= self.floor[q]
        q, c = np.concatenate([self.q, q[good]]), np.concatenate([self.c, c[good]])
        score = np.concatenate([self.score, score[good]])
        order = np.lexsort((self.ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        last = rank == self.nearest - 1
        self.floor[q[last]] = score[last]
        top = rank < self.nearest
        self.q, self.c, self.score = q[top], c[top], score[top]


def _searcher(nearest: int):
    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and candidates.num_rows:
            names, vectors = queries.column("vec_id").to_numpy(), _matrix(queries.column("vector"), "<f8")
            ids, originals = candidates.column("vec_id").to_numpy(), _matrix(candidates.column("vector"), "<f8")
            turn = rotation(vectors.shape[1])
            size = turn.shape[1]
            length, correction = (candidates.column(c).to_numpy() for c in ("length", "correction"))
            bits = np.unpackbits(_matrix(candidates.column("code"), np.uint8), axis=1, count=size)
            signs = (bits.astype(np.float32) * 2 - 1).T
            scale = (length / correction / np.sqrt(size)).astype(np.float32)
            spread = np.sqrt(np.maximum(0, 1 - correction**2)) / correction / np.sqrt(max(size - 1, 1))
            bound = (WIDTH * spread * length).astype(np.float32)
            own_length = np.linalg.norm(vectors, axis=1)
            turned = (vectors @ turn).astype(np.float32)
            step = max(1, CELLS // len(ids))
            for a in range(0, len(names), step):
                asked, far = vectors[a : a + step], own_length[a : a + step]
                estimate = (turned[a : a + step] @ signs) * scale
                own = names[a : a + step, None] == ids[None, :]
                estimate[own] = -np.inf
                upper = estimate + bound * far[:, None].astype(np.float32)
                best = _Best(len(asked), nearest, ids)
                if len(ids) > 2 * nearest:
                    some = np.argpartition(-estimate, 2 * nearest, axis=1)[:, : 2 * nearest]
                    q, c = np.repeat(np.arange(len(some)), 2 * nearest), some.ravel()
                    first = ~own[q, c]
                    q, c = q[first], c[first]
                    best.add(q, c, _exact(asked[q], originals[c]))
                    upper[q, c] = -np.inf
                upper[own] = -np.inf
                # Estimates are rounded; the bound is widened by more than that. What is not a number is looked at.
                slack = 1e-4 * far * length.max()
                q, c = np.nonzero(~(upper < (best.floor - slack)[:, None]) & (upper != -np.inf))
                order = np.argsort(-estimate[q, c])
                for k in range(0, len(order), PIECE):
                    some = order[k : k + PIECE]
                    some = some[~(upper[q[some], c[some]] < (best.floor - slack)[q[some]])]
                    best.add(q[some], c[some], _exact(asked[q[some]], originals[c[some]]))
                out["query_id"].append(names[a + best.q])
                out["vec_id"].append(ids[best.c])
                out["score"].append(best.score)
        types = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({k: pa.array(np.concatenate(v) if v else [], types[k]) for k, v in out.items()})

    return search


def nearest_neighbours(index: DataFrame, queries: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """The ``nearest`` rows of an index for every query: query_id, rank from 1, vec_id, score.

    Both are results of :func:`encode`. A candidate of the query's id is never returned. Vectors meet those of the same
    number of dimensions only. Rows that repeat an id and vector count once; of a query id with several vectors the
    least in bytes is asked for; equal scores go to the smaller id.
    """
    asked = queries.groupBy("vec_id", "dims").agg(F.min("vector").alias("vector"))
    kept = index.distinct()
    counts = index.groupBy("dims").agg(F.count("*").alias("n"))
    sides = counts.join(asked.groupBy("dims").agg(F.count("*").alias("m")), "dims")
    blocks = sides.select(
        "dims",
        F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("q_blocks"),
        F.greatest(F.ceil(F.col("n") / CANDIDATE_BLOCK), F.lit(LEAST_BLOCKS)).cast("int").alias("c_blocks"),
    )

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        return (
            frame.join(blocks, "dims")
            .withColumn(own, F.pmod(F.xxhash64("vec_id"), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
        )

    place = ["dims", "q_block", "c_block"]
    left, right = [*place, "vec_id", "vector"], [*place, "vec_id", "vector", "code", "length", "correction"]
    one = dealt(asked, "q_block", "c_block").select(*left).toDF(*left)
    two = dealt(kept, "c_block", "q_block").select(*right).toDF(*right)
    found = one.groupBy(*place).cogroup(two.groupBy(*place)).applyInArrow(_searcher(nearest), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op9_rotated_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20. All rows are indexed."""
    index = stored(encode(table(spark, folder, "embeddings")), "vector-codes")
    return nearest_neighbours(index, index.filter(F.col("vec_id") % EVERY == 0))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""
