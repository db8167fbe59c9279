"""Periodic runs of words: maximal stretches that repeat a period at least four times.

A run of period q, with B <= q < 2B for a power of two B, holds a block of B words that starts at a multiple of B, and holds the
same words again q further on. So at every dyadic scale B

1. each block is laid over the window of the words B to 3B after its start. The sum of the squared differences between the
   words' numbers is zero where the window repeats the block, and nowhere else. All B sums of a block come from one
   convolution, a number-theoretic transform over primes whose product exceeds every sum, so zero is exact;
2. a distance at which a block recurs seeds an extension to both sides, as far as words that distance apart are the same.
   Stretches of four periods are runs; where one stretch has several periods, the smallest is its own.

Two things spare work without losing a run. A block whose first words do not recur within its window is not transformed. Nor
is one that lies with its window in a run of a smaller period: there it recurs only at multiples of that period.

Many short texts are looked at together, side by side; a block never reaches beyond its text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelstat.llm.common import WORD, mix, sized_slices, table, text_bytes, word_spans

# A run has this many periods and words at least.
PERIODS, WORDS = 4, 6
# Words at a block's start that must recur for the block to be transformed.
HEAD = 4
# Words that are transformed at once.
CELLS = 1 << 19
# Primes of the form c * 2**k + 1, and a primitive root of all four.
PRIMES, ROOT = (998244353, 2281701377, 469762049, 167772161), 3

RUNS = "doc_id long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


@functools.lru_cache(maxsize=128)
def _twiddles(size: int, prime: int, inverse: bool) -> list[np.ndarray]:
    """The powers of a root of unity that each step of a transform of this size multiplies by."""
    steps = []
    while size > 1:
        root = pow(ROOT, (prime - 1) // size, prime)
        if inverse:
            root = pow(root, -1, prime)
        row = np.ones(size // 2, np.int64)
        have = 1
        while have < len(row):
            more = min(have, len(row) - have)
            row[have : have + more] = row[:more] * pow(root, have, prime) % prime
            have += more
        steps.append(row)
        size //= 2
    return steps


def _transform(rows: np.ndarray, prime: int) -> np.ndarray:
    """The transform of every row, in bit-reversed order. The rows are changed."""
    n, size = rows.shape
    for row in _twiddles(size, prime, False):
        half = len(row)
        parts = rows.reshape(n, -1, 2, half)
        low, high = parts[:, :, 0, :], parts[:, :, 1, :]
        apart = (low - high) * row % prime
        parts[:, :, 0, :] = (low + high) % prime
        parts[:, :, 1, :] = apart
    return rows


def _transform_back(rows: np.ndarray, prime: int) -> np.ndarray:
    """The inverse of :func:`_transform`. The rows are changed."""
    n, size = rows.shape
    for row in reversed(_twiddles(size, prime, True)):
        half = len(row)
        parts = rows.reshape(n, -1, 2, half)
        low, high = parts[:, :, 0, :], parts[:, :, 1, :] * row % prime
        apart = (low - high) % prime
        parts[:, :, 0, :] = (low + high) % prime
        parts[:, :, 1, :] = apart
    return rows * pow(size, -1, prime) % prime


def recurrences(numbers: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The (block start, distance) pairs, distances from ``size`` to below twice as much, at which a block recurs.

    ``size`` is a power of two; ``numbers`` must reach 3 * size - 1 words beyond each start.
    """
    found = []
    top = int(numbers.max(initial=0))
    # As many primes as make every sum smaller than their product.
    primes, product = [], 1
    for prime in PRIMES:
        if (prime - 1) % (2 * size):
            continue
        primes.append(prime)
        product *= prime
        if size * top * top < product:
            break
    else:
        raise ValueError(f"texts of {len(numbers)} words are beyond the transform's primes")
    step = max(1, CELLS // (2 * size))
    for k in range(0, len(blocks), step):
        starts = blocks[k : k + step]
        block = numbers[starts[:, None] + np.arange(size)]
        window = numbers[starts[:, None] + size + np.arange(2 * size - 1)]
        zero = np.ones((len(starts), size), bool)
        for prime in primes:
            one = np.zeros((len(starts), 2 * size), np.int64)
            one[:, :size] = block[:, ::-1] % prime
            two = np.zeros_like(one)
            two[:, :-1] = window % prime
            product_sums = _transform_back(_transform(one, prime) * _transform(two, prime) % prime, prime)
            products = product_sums[:, size - 1 : 2 * size - 1]
            squares = np.zeros((len(starts), 2 * size), np.int64)
            np.cumsum((window % prime) ** 2 % prime, axis=1, out=squares[:, 1:])
            sums = squares[:, size:] - squares[:, :size]
            own = ((block % prime) ** 2 % prime).sum(axis=1)
            zero &= (own[:, None] + sums - 2 * products) % prime == 0
        row, shift = np.nonzero(zero)
        found.append((starts[row], shift + size))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(part) for part in zip(*found))


class _Heads:
    """Where the same first words stand again."""

    def __init__(self, numbers: np.ndarray, width: int):
        n = len(numbers) - width + 1
        key = numbers[:n].astype(np.uint64)
        for k in range(1, width):
            key = mix(key) ^ numbers[k : n + k].astype(np.uint64)
        # Equal keys may stand for different words; they only let a block through.
        _, self.rank = np.unique(key, return_inverse=True)
        self.span = n + 1
        self.places = np.sort(self.rank * self.span + np.arange(n))

    def recur(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Whether the head of each start stands again at a distance from ``size`` to below twice as much."""
        base = self.rank[starts] * self.span + starts
        at = np.searchsorted(self.places, base + size)
        following = self.places[np.minimum(at, len(self.places) - 1)]
        return (following >= base + size) & (following < np.minimum(base + 2 * size, (self.rank[starts] + 1) * self.span))


def _reach(numbers: np.ndarray, starts: np.ndarray, distances: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """How many words from each start on, forward or backward, equal those ``distance`` further on, at most ``room``."""
    length = np.zeros(len(starts), np.int64)
    going, width = np.arange(len(starts)), 16
    while len(going):
        for k in range(0, len(going), max(1, CELLS // width)):
            some = going[k : k + max(1, CELLS // width)]
            steps = np.arange(width)
            inside = length[some, None] + steps < room[some, None]
            at = starts[some, None] + way * (length[some, None] + steps)
            at = np.where(inside, at, starts[some, None])
            same = inside & (numbers[at] == numbers[np.where(inside, at + distances[some, None], at)])
            length[some] += np.where(same.all(axis=1), width, same.argmin(axis=1))
            going[k : k + len(some)] = np.where(same.all(axis=1), some, -1)
        going, width = going[going >= 0], min(2 * width, CELLS)
    return length


def find_runs(numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of the runs of texts that stand end to end, in order of start and period.

    Equal words have equal numbers within a text; text k has the places from bounds[k] to bounds[k + 1].
    """
    none = np.zeros(0, np.int64)
    begin, end, period = none, none, none
    lengths = np.diff(bounds)
    longest = int(lengths.max(initial=0))
    size, heads = 1, {}
    while longest >= max(WORDS, PERIODS * size):
        # Starts of the blocks that leave room for one more of their size in their text.
        many = np.where(lengths >= max(WORDS, PERIODS * size), lengths // size - 1, 0)
        text = np.repeat(np.arange(len(lengths)), many)
        starts = bounds[text] + size * (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many))
        last = bounds[text + 1]
        # Ends of the runs known so far that began by then, as far as the farthest.
        order = np.argsort(begin, kind="stable")
        sorted_begin = begin[order]
        farthest = np.append(-1, np.maximum.accumulate(end[order])) if len(order) else np.array([-1])
        covered = farthest[np.searchsorted(sorted_begin, starts, side="right")]
        width = min(size, HEAD)
        if width not in heads:
            heads[width] = _Heads(numbers, width)
        wanted = (covered < starts + 3 * size) & heads[width].recur(starts, size)
        starts, last, covered = starts[wanted], last[wanted], covered[wanted]
        padded = np.concatenate([numbers, np.zeros(3 * size, np.int64)]) if len(starts) else numbers
        at, distance = recurrences(padded, starts, size)
        where = np.searchsorted(starts, at)
        new = (at + distance + size <= last[where]) & (at + distance + size > covered[where])
        at, distance, last = at[new], distance[new], last[where][new]
        # Neighbouring blocks that recur at the same distance are one seed, the first of them.
        order = np.lexsort((at, distance))
        at, distance, last = at[order], distance[order], last[order]
        head = np.ones(len(at), bool)
        head[1:] = (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + size) | (last[1:] != last[:-1])
        at, distance, last = at[head], distance[head], last[head]
        first = bounds[np.searchsorted(bounds, at, side="right") - 1]
        ahead = _reach(numbers, at, distance, last - distance - at, 1)
        behind = _reach(numbers, at - 1, distance, at - first, -1) if len(at) else none
        found = np.stack([at - behind, at + ahead + distance, distance])
        long = found[1] - found[0] >= np.maximum(WORDS, PERIODS * distance)
        found = np.unique(np.concatenate([np.stack([begin, end, period]), found[:, long]], axis=1), axis=1)
        # Sorted by start, end and period: the first of a stretch has its smallest period.
        least = np.ones(found.shape[1], bool)
        least[1:] = (found[:2, 1:] != found[:2, :-1]).any(axis=0)
        begin, end, period = found[:, least]
        size *= 2
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def _numbered(data: np.ndarray, first: np.ndarray, last: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Numbers of words, alike for equal words; those of one text are small, counted from 0."""
    lengths = last - first
    ends = np.cumsum(lengths)
    inside = np.repeat(first - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(data[inside])]
    )
    whole = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pairs, back = np.unique(text * (len(whole) + 1) + whole, return_inverse=True)
    owner = pairs // (len(whole) + 1)
    return (np.arange(len(pairs)) - np.searchsorted(owner, owner))[back]


def _collapsed(data: np.ndarray, first: np.ndarray, last: np.ndarray, kept: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The kept words of every text, joined by one space."""
    counts = np.concatenate([[0], np.cumsum(kept)])[bounds]
    first, last = first[kept], last[kept]
    # Each word takes the byte after it along, which becomes the space; the last one of a text does not.
    lengths = last - first + 1
    stops = counts[1:][counts[1:] > counts[:-1]]
    lengths[stops - 1] -= 1
    ends = np.cumsum(lengths)
    inside = np.repeat(first - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    out = np.append(data, np.uint8(32))[inside]
    spaces = np.ones(len(lengths), bool)
    spaces[stops - 1] = False
    out[ends[spaces] - 1] = 32
    offsets = np.append(0, ends)[counts]
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sized_slices(batches, 1):
        data, starts = text_bytes(batch.column(1))
        first, last, rows = word_spans(data, starts)
        bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        numbers = _numbered(data, first, last, bounds)
        begin, end, period = find_runs(numbers, bounds)
        dropped = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(dropped, begin + period, 1)
        np.add.at(dropped, end, -1)
        kept = np.cumsum(dropped[:-1]) == 0
        places = np.searchsorted(begin, bounds)
        own = begin - bounds[np.searchsorted(bounds, begin, side="right") - 1]
        runs = pa.StructArray.from_arrays([pa.array(own), pa.array(end - begin), pa.array(period)], fields=list(_RUN))
        lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), runs)
        text = _collapsed(data, first, last, kept, bounds)
        yield pa.RecordBatch.from_arrays([batch.column(0), lists, text], schema=_SCHEMA)


def periodic_runs(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, ``runs`` (start, length, period, counted in words, in order) and the ``collapsed`` text.

    Needs doc_id and text; other columns are ignored. Words are runs of anything but ASCII white space; a null text has
    none. A run is a stretch of its smallest period, at least four periods and six words long, that no neighbouring word
    extends. In the collapsed text each run keeps its first period only, and words are joined by one space. Repeated rows
    are returned each, no row gives none.
    """
    needed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return needed.mapInArrow(_rows, RUNS)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, of which a tenth of the ids get a periodic end. A null id leaves it as it is."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
    joined = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")
    return F.when((h % 10 == 0) & (F.regexp_count(text, F.lit(WORD)) > 0), joined).otherwise(text)


def op11_periodic(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of every document, with planted ends, as counts, the longest run and checksums."""
    documents = table(spark, folder, "documents")
    found = periodic_runs(documents.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    top = found.withColumn("top", longest)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.n").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.expr("1000 * top.n div -top.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP11_SQL = r"""
WITH i AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS own,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda s, c: list_reduce(list_prepend(xor(s, c), range(8)),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295::BIGINT) AS h
  FROM documents),
a AS (SELECT *, len(own) AS n, CASE WHEN len(own) > 0 THEN (h // 10) % len(own) ELSE 0 END AS begin, h // 10 AS g FROM i),
b AS (SELECT *, 1 + (n - begin) // (3 + g % 8) AS p FROM a),
d AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda k: own[(CASE WHEN k < begin THEN k ELSE begin + (k - begin) % p END) + 1]) ELSE own END AS words
  FROM b),
f AS (SELECT doc_id, n, unnest(range(0, n - 3)) AS pos, words FROM d WHERE n >= 6),
q AS (SELECT doc_id, n, pos, array_to_string(words[pos + 1:pos + 4], ' ') AS head FROM f),
z AS (SELECT x.doc_id, x.pos, y.pos - x.pos AS period FROM q x JOIN q y ON x.doc_id = y.doc_id AND x.head = y.head AND y.pos > x.pos AND 4 * (y.pos - x.pos) <= x.n),
j AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, period ORDER BY pos) AS island FROM z),
t AS (SELECT doc_id, period, min(pos) AS start, count(*) + 3 + period AS length FROM j GROUP BY doc_id, period, island),
r AS (
  SELECT doc_id, start, length, min(period) AS period FROM t WHERE length >= greatest(6, 4 * period) GROUP BY 1, 2, 3),
l AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first({'s': start, 'n': length, 'p': period} ORDER BY length DESC, start, period) AS top
  FROM r GROUP BY 1),
x AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS pos FROM r),
v AS (SELECT doc_id, unnest(range(0, n)) AS pos, unnest(words) AS word FROM d WHERE n > 0),
k AS (SELECT v.doc_id, string_agg(word, ' ' ORDER BY v.pos) AS text FROM v ANTI JOIN x ON x.doc_id = v.doc_id AND x.pos = v.pos GROUP BY 1)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start, top.n::BIGINT AS length, top.p::BIGINT AS period,
  (1000 * top.n // top.p)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM d LEFT JOIN l ON l.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""
