"""Helpers shared by the corpus operators: tables, the shared folder, Arrow batches and byte hashing."""

from __future__ import annotations

import contextlib
import sys
import threading
import types
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from reelstat.session import scratch_path

T = TypeVar("T")

# A word of a text: a longest run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Drops the shuffle files of a query when it ends; the written table holds all that is needed of them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCOPES = threading.local()


def _scopes() -> list[list[str]]:
    if not hasattr(_SCOPES, "open"):
        _SCOPES.open = []
    return _SCOPES.open


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop at the end what was stored inside, but for tables that outlive it."""
    paths: list[str] = []
    _scopes().append(paths)
    try:
        yield
    finally:
        _scopes().remove(paths)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(frame: DataFrame, name: str, outlives: bool = False) -> DataFrame:
    """Write a frame once to the shared folder and read it back; later stages survive a lost executor.

    Inside a :func:`scratch` block the table goes with the block. One that ``outlives`` it holds the block's result and
    goes with the block around it, if there is one.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    scopes = _scopes()[:-1] if outlives else _scopes()
    if scopes:
        scopes[-1].append(path)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


# What a file counts for, besides its size, where files are put together for a task.
_FILE_COST, _TASK_BYTES = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"


@contextlib.contextmanager
def file_by_file(spark: SparkSession) -> Iterator[None]:
    """What is read inside goes to tasks of one file each: a stored table to tasks as small as those that wrote it."""
    before = spark.conf.get(_FILE_COST)
    spark.conf.set(_FILE_COST, spark.conf.get(_TASK_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_FILE_COST, before)


def free_name(columns: list[str], name: str) -> str:
    """A column name that starts with ``name`` and that no column has or starts with, whatever its case."""
    taken = [c.lower() for c in columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name


def kept_by_worker(name: str, make: Callable[[], T]) -> T:
    """What ``make`` gives, made once in the life of a Python process and found again by its name.

    The package travels to workers by value, so its own globals are new in every task.
    """
    home = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def shuffle_width(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Rows and bytes of text that a worker looks at together.
SLICE_ROWS, SLICE_BYTES = 4096, 4 << 20


def sized_slices(
    batches: Iterator[pa.RecordBatch], column: int, rows: int = SLICE_ROWS, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds few rows and few bytes of text, or one long text."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column).cast(pa.large_binary())).fill_null(0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False)) if batch.num_rows else []
        start, before = 0, 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, before + size, side="right"))
            stop = min(max(stop, start + 1), start + rows)
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and where each row starts (one more than rows).

    Nulls count as empty.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or starts[-1] == starts[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


# Fixed odd multiplier of the polynomial hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = _POWERS[base] = np.multiply.accumulate(known)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash of a byte array; entry i covers the first i bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal spans have equal hashes wherever they lie."""
    inverse = powers(_INVERSE, len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def is_space(data: np.ndarray) -> np.ndarray:
    """Where a byte is one of the six ASCII white-space characters."""
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the row it belongs to. Words do not cross rows."""
    inside = ~is_space(data)
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[starts[:-1][starts[:-1] < len(data)]] = False
    first = np.flatnonzero(inside & ~before)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    ends = starts[1:]
    after[ends[ends > 0] - 1] = False
    last = np.flatnonzero(inside & ~after) + 1
    rows = np.searchsorted(starts, first, side="right") - 1
    return first, last, rows


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return data + 32 * ((data >= 65) & (data <= 90)).astype(np.uint8)

