"""Whitening of embeddings by the covariance of their distinct vectors.

Vectors are turned into whole numbers, and identical ones are grouped: a group counts once in the fit, or as often as it
has rows. Means and the centred covariance are sums of one matrix product per batch; only sums of a dimension's square leave
a task. Each distinct vector is projected once on the leading components, and the rows take the result by a join.

The fit goes through the driver as one matrix of dimension by dimension for each length of vector, and no row does. Vectors
of different lengths are fitted apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelstat.llm.common import stored, table

# An entry c stands as floor(SCALE * c) + SHIFT, held within +-LIMIT.
SCALE, SHIFT, LIMIT = 64, 1_000_000, 1 << 40
COMPONENTS = 16
# Eigenvalues below this share of the greatest are rounding errors of a degenerate fit; they span no component.
DEGENERATE = 1e-12

WHITE = "dims int, key binary, n long, deviation long, whitened array<double>"


def usable(vectors: DataFrame) -> DataFrame:
    """The rows whose vector is neither null nor empty and has finite entries only: vec_id, ``dims`` and ``key``.

    ``key`` is the vector in whole numbers, packed as big-endian 64-bit values.
    """
    fine = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).filter((F.size("vector") > 0) & F.coalesce(fine, F.lit(False)))
    return rows.mapInArrow(_keyed, "vec_id long, dims int, key binary")


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        entries = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False))
        whole = np.clip(entries, -LIMIT, LIMIT).astype(np.int64) + SHIFT
        data = whole.astype(">i8").tobytes()
        ends = 8 * np.cumsum(lengths)
        keys = pa.array([data[b - 8 * n : b] for n, b in zip(lengths.tolist(), ends.tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lengths.astype(np.int32)), keys], names=["vec_id", "dims", "key"]
        )


def distinct_vectors(rows: DataFrame, weighted: bool = False) -> DataFrame:
    """Each distinct vector of :func:`usable` rows once, with its number of rows or 1 as its weight in the fit."""
    weight = F.count("*") if weighted else F.lit(1).cast("long")
    return rows.groupBy("dims", "key").agg(weight.alias("weight"))


@dataclass
class Fit:
    """Sums, mean and leading components of the vectors of one length."""

    n: int
    sums: list[int]
    mean: np.ndarray
    # Column k holds the k-th unit eigenvector.
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Positions and vectors of the rows of each length in a batch with columns dims and key."""
    dims = batch.column(0).to_numpy()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        keys = batch.column(1).take(pa.array(at)).to_pylist()
        yield int(d), at, np.frombuffer(b"".join(keys), ">i8").reshape(len(at), d).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dims, i, n, high, low): weight and weighted sum of every dimension, as high * 2**20 + low, of a task."""
    found: dict[int, list] = {}
    for batch in batches:
        weights = batch.column(2).to_numpy()
        for d, at, x in _matrices(batch):
            own = found.setdefault(d, [0, [0] * d])
            own[0] += int(weights[at].sum())
            # Two halves keep the products of a batch within 64 bits, whatever the weights are.
            low = (weights[at, None] * (x & 0xFFFFF)).sum(axis=0)
            high = (weights[at, None] * (x >> 20)).sum(axis=0)
            own[1] = [s + (int(b) << 20) + int(a) for s, a, b in zip(own[1], low, high)]
    for d, (n, sums) in found.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d] * d, pa.int32()),
                pa.array(range(d), pa.int32()),
                pa.array([n] * d, pa.int64()),
                pa.array([s >> 20 for s in sums], pa.int64()),
                pa.array([s & 0xFFFFF for s in sums], pa.int64()),
            ],
            names=["dims", "i", "n", "high", "low"],
        )


def _products(means: dict[int, np.ndarray]):
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(dims, i, j, value): weighted sums of centred products of a task, for i <= j."""
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column(2).to_numpy()
            for d, at, x in _matrices(batch):
                centred = x - means[d]
                found[d] = found.get(d, 0) + centred.T @ (weights[at, None] * centred)
        for d, square in found.items():
            i, j = np.triu_indices(d)
            columns = [pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(square[i, j])], names=["dims", "i", "j", "value"])

    return products


def fit(groups: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each length of vector, from the (dims, key, weight) rows of :func:`distinct_vectors`."""
    exact = "decimal(38,0)"
    totals = groups.select("dims", "key", "weight").mapInArrow(_sums, "dims int, i int, n long, high long, low long")
    totals = totals.groupBy("dims", "i").agg(
        *[F.sum(F.col(c).cast(exact)).cast(exact).alias(c) for c in ("n", "high", "low")]
    )
    numbers: dict[int, int] = {}
    sums: dict[int, list[int]] = {}
    for r in totals.collect():
        numbers[r["dims"]] = int(r["n"])
        sums.setdefault(r["dims"], [0] * r["dims"])[r["i"]] = (int(r["high"]) << 20) + int(r["low"])
    # The whole part of a mean apart from the rest, which a division of large numbers would round.
    means = {d: np.array([s // numbers[d] + (s % numbers[d]) / numbers[d] for s in own]) for d, own in sums.items()}
    squares = groups.select("dims", "key", "weight").mapInArrow(_products(means), "dims int, i int, j int, value double")
    cells = squares.groupBy("dims", "i", "j").agg(F.sum("value").alias("value")).toArrow()
    fits = {}
    for d, n in numbers.items():
        own = cells.filter(pc.equal(cells.column("dims"), d))
        i, j = (own.column(c).to_numpy() for c in ("i", "j"))
        covariance = np.zeros((d, d))
        covariance[i, j] = covariance[j, i] = own.column("value").to_numpy() / n
        values, axes = np.linalg.eigh(covariance)
        values, axes = values[::-1], axes[:, ::-1]
        # The sign of a component is free; its largest entry is positive.
        largest = np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], 0)
        axes = axes * np.where(largest < 0, -1, 1)
        kept = values[:components] > DEGENERATE * max(values[0], 0)
        k = int(kept.sum()) if values[0] > 0 else 0
        trace = float(np.trace(covariance))
        share = values[:k] / trace if trace > 0 else values[:0]
        fits[d] = Fit(n, sums[d], means[d], axes[:, :k], values[:k], share)
    return fits


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of (n * x - S)**2, exactly; null where they exceed 64 bits."""
    most = n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in sums)
    if most < 1 << 62:
        apart = n * x - np.array(sums, np.int64)
        if float((apart.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) < 2.0**62:
            return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def _projected(fits: dict[int, Fit]):
    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, x in _matrices(batch):
                own = fits[d]
                white = (x - own.mean) @ own.components / np.sqrt(own.eigenvalues)
                k = white.shape[1]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(at) + 1) * k, pa.int32()), pa.array(white.ravel(), pa.float64())
                )
                dims, keys = (batch.column(c).take(pa.array(at)) for c in range(2))
                n = pa.array(np.full(len(at), own.n), pa.int64())
                deviation = pa.array(_deviation(x, own.n, own.sums), pa.int64())
                weight = batch.column(2).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [dims, keys, n, deviation, lists, weight],
                    names=["dims", "key", "n", "deviation", "whitened", "weight"],
                )

    return projected


def whiten(groups: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """Each distinct vector's ``n``, ``deviation`` from the mean and ``whitened`` components."""
    return groups.select("dims", "key", "weight").mapInArrow(_projected(fits), f"{WHITE}, weight long")


def _white_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dims, i, j, value): weighted sums of products of whitened components of a task, for i <= j."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        weights, dims = batch.column(2).to_numpy(), batch.column(0).to_numpy()
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            z = batch.column(1).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
            found[int(d)] = found.get(int(d), 0) + z.T @ (weights[at, None] * z)
    for d, square in found.items():
        i, j = np.triu_indices(len(square))
        columns = [pa.array(c, pa.int32()) for c in (np.full(len(i), d), i, j)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(square[i, j])], names=["dims", "i", "j", "value"])


def identity_errors(white: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Per length the largest entry of the whitened covariance less the identity. Whitened values are centred already."""
    cells = white.select("dims", "whitened", "weight").mapInArrow(_white_products, "dims int, i int, j int, value double")
    errors: dict[int, float] = {}
    for r in cells.groupBy("dims", "i", "j").agg(F.sum("value").alias("value")).collect():
        apart = abs(r["value"] / fits[r["dims"]].n - (r["i"] == r["j"]))
        errors[r["dims"]] = max(errors.get(r["dims"], 0.0), apart)
    return errors


def _by_length(values: dict[int, list]) -> Column:
    """The value of a row's length of vector, from as many literals as there are lengths."""
    found = F.lit(None)
    for d, value in values.items():
        found = F.when(F.col("dims") == d, F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)).otherwise(found)
    return found


def whitened_rows(vectors: DataFrame, weighted: bool = False, components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Needs vec_id and embedding; other columns are ignored. Rows whose vector is null, empty or holds a null or a number that
    is not finite are left out, entries beyond LIMIT / SCALE are held there. Repeated rows are returned each. A fit without
    spread (one distinct vector) has no components and gives no rows, a smaller rank gives as many components as it has.
    A deviation beyond 64 bits is null. With ``weighted`` a vector weighs as many rows as hold it.
    """
    rows = stored(usable(vectors), "vectors")
    groups = stored(distinct_vectors(rows, weighted), "distinct-vectors")
    fits = fit(groups, components)
    white = stored(whiten(groups, fits), "white-vectors")
    errors = identity_errors(white, fits)
    # Copies of one vector meet its one group: a skewed partition is split by the rows, the group is repeated for each part.
    both = rows.join(white.drop("weight"), ["dims", "key"])
    each = both.select("vec_id", "dims", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = _by_length({d: own.explained.tolist() for d, own in fits.items() if len(own.explained)})
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(explained.cast("array<double>"), F.col("at")).alias("explained"),
        _by_length(errors).cast("double").alias("identity_error"),
    )


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The whitened components of all embeddings, fitted on each distinct vector once."""
    return whitened_rows(table(spark, folder, "embeddings"))
