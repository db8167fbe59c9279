"""Remove long byte strings that occur more than once in a corpus.

Every 400-byte window of every text is judged against all others, in four steps.

1. Windows are dealt out by content: the least hash of the 32-byte strings in a window is its key, and neighbouring
   windows of the same key form one stretch. Equal windows have equal keys, and a window lies in one stretch only.
2. Equal stretches collapse: where one occurs at two places, all its windows are repeated.
   A key with a single stretch needs no more work.
3. Stretches of keys that hold several different ones are cut into parts of at most 32 windows, by the place of the key's
   string in a window. All windows of a part share a core of 369 bytes: where no other part has the same core, none of its
   windows is repeated, and where another part is the same as a whole, all are.
4. What is left are parts at the borders of repeats, and stretches that hold their key's string more than once. Their
   bytes are gathered in buckets of bounded size, where a few symbols stand for the core of a part: at most 62 bytes
   around it are left. In each the suffixes are sorted, and breadth-first backward extension on the Burrows-Wheeler
   transform finds the common prefixes of neighbouring suffixes by increasing length. It stops below the length of a
   window, 400 bytes or the 31 around a core and its symbols: what is not reached by then shares a window or more.

A passage copied into very many different texts makes some keys hot. The windows of such keys are dealt out anew with
rare strings before frequent ones, by a mergeable count sketch: then a window that holds anything of its own
goes to a key of its own, and windows inside the passage collapse.

Passages can be told by words too. Then each word of a text is written as a number of four bytes, and windows of that many
words are judged in the same steps, whatever their length in bytes and the white space between.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from reelstat.llm.common import (
    free_name,
    mix,
    prefix_hashes,
    scratch,
    shuffle_width,
    sized_slices,
    span_hashes,
    stored,
    table,
    text_bytes,
    word_spans,
)

LENGTH = 400
GRAM = 32
# Bytes of the number that stands for a word, and words of a passage that the pipeline's stage takes out.
WORD_BYTES = 4
PASSAGE_WORDS = 50
# Bytes of stretches that one task compares, and beyond which a single key counts as hot.
BUCKET_BYTES = 1 << 20
HOT_BYTES = 1 << 18
# Windows of a part.
PART = 32
# Counters of the sketch, and how many of them travel in one row.
COUNTERS, CHUNK = 1 << 20, 1 << 14
# Slots that texts are counted by, the share of a slot beyond which it is crowded, and parts of a crowded one.
SLOTS, CROWD, PARTS = 4096, 8, 32
# Bytes of text of which the windows are keyed at once.
SLICE = 1 << 20

_PLACE = [("t1", pa.int64()), ("t2", pa.int64()), ("start", pa.int64()), ("n", pa.int64())]
_STRETCH = pa.schema([*_PLACE, ("key", pa.int64()), ("content", pa.int64()), ("inner", pa.bool_())])
STRETCH = "t1 long, t2 long, start long, n long, key long, content long, inner boolean"
# A part of a stretch, with the bytes it has before its core.
_PART = _STRETCH.append(pa.field("lead", pa.int64()))
PART_ROW = f"{STRETCH}, lead long"
# The lead is null where the bytes are whole; else the core is left out after that many.
_PIECE = pa.schema([*_PLACE, ("key", pa.int64()), ("hot", pa.bool_()), ("lead", pa.int64()), ("bytes", pa.binary())])
PIECE = "t1 long, t2 long, start long, n long, key long, hot boolean, lead long, bytes binary"
SPAN = "t1 long, t2 long, start long, end long"
RUNS = "array<struct<start: bigint, end: bigint>>"


def text_key() -> list[Column]:
    """Two independent hashes that name a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("again"), text, F.octet_length(text)).alias("t2")]


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values."""
    n = len(h) - width + 1
    if n <= 0:
        return h[:0]
    blocks = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(h)] = h
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def word_codes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with WORD_BYTES bytes of its hash for each word, end to end, and where each row starts."""
    first, last, rows = word_spans(data, starts)
    codes = np.zeros(len(first), "<u4")
    cuts = np.unique(np.searchsorted(first, np.arange(0, len(data) + SLICE, SLICE)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        base = first[a]
        hashes = span_hashes(prefix_hashes(data[base : last[b - 1]]), first[a:b] - base, last[a:b] - base)
        codes[a:b] = hashes >> np.uint64(32)
    sizes = WORD_BYTES * np.bincount(rows, minlength=len(starts) - 1)
    return codes.view(np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def stretches(data: np.ndarray, starts: np.ndarray, length: int, counts: np.ndarray | None = None):
    """Stretches of windows of equal key: row, start in the row, number of windows, key, hash of the bytes, and
    whether the string of the key stands in it more than once, so that windows may repeat within.

    With ``counts`` the keys prefer strings that the sketch counts less often.
    """
    n = len(data)
    if n < length:
        return [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool)]
    prefix = prefix_hashes(data)
    at = np.arange(n - GRAM + 1)
    h = span_hashes(prefix, at, at + GRAM)
    if counts is not None:
        rank = np.log2(counts[(h % np.uint64(COUNTERS)).astype(np.int64)] + 1.0).astype(np.uint64)
        h = (rank << np.uint64(56)) | (h >> np.uint64(8))
    keys = _sliding_least(h, length - GRAM + 1)
    valid = np.zeros(len(keys), bool)
    long = np.flatnonzero(np.diff(starts) >= length)
    change = np.zeros(len(keys) + 1, np.int32)
    np.add.at(change, starts[long], 1)
    np.add.at(change, starts[long + 1] - length + 1, -1)
    valid = np.cumsum(change[:-1]) > 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (keys[1:] != keys[:-1])
    first[starts[long]] = True
    begin = np.flatnonzero(first)
    if not len(begin):
        return [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool)]
    # A stretch ends before the next one, or at the last window of its row.
    row = np.searchsorted(starts, begin, side="right") - 1
    stop = np.minimum(np.append(begin[1:], len(keys)), starts[row + 1] - length + 1)
    content = span_hashes(prefix, begin, stop + length - 1)
    least = keys[begin]
    inner = np.fromiter(
        (
            np.count_nonzero(h[a:b] == k) > 1
            for a, b, k in zip(begin.tolist(), (stop + length - GRAM).tolist(), least)
        ),
        bool,
        len(begin),
    )
    return [row, begin - starts[row], stop - begin, least.view(np.int64), content.view(np.int64), inner]


def _windows(length: int, words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches of the texts (t1, t2, text). A very long text is keyed in parts that overlap."""
        for batch in sized_slices(batches, 2, size=SLICE):
            data, starts = text_bytes(batch.column(2))
            if words:
                data, starts = word_codes(data, starts)
            names = [batch.column(k).to_numpy() for k in (0, 1)]
            parts = [(data, starts, 0)]
            if batch.num_rows == 1 and len(data) > 2 * SLICE:
                cuts = range(0, len(data) - length + 1, SLICE)
                parts = [(data[a : a + SLICE + length - 1], None, a) for a in cuts]
            for own, at, base in parts:
                at = np.array([0, len(own)]) if at is None else at
                row, start, n, key, content, inner = stretches(own, at, length)
                columns = [names[0][row], names[1][row], start + base, n, key, content, inner]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_STRETCH)

    return run


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (t1, t2, text, places) with the numbers of the words instead of the text."""
    for batch in sized_slices(batches, 2, size=SLICE):
        data, starts = word_codes(*text_bytes(batch.column(2)))
        buffers = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, buffers).cast(pa.binary())
        columns = [coded if k == 2 else c for k, c in enumerate(batch.columns)]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the listed stretches of each text (t1, t2, text, list of start, n, key, hot, lead).

        Those of a part go without its core, unless its key is hot.
        """
        core = length - PART + 1
        for batch in sized_slices(batches, 2, rows=256):
            rows = []
            texts = batch.column(2).cast(pa.binary())
            for t1, t2, text, places in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(1), texts, batch.column(3)))):
                for p in places:
                    piece = text[p["start"] : p["start"] + p["n"] + length - 1]
                    lead = None if p["hot"] else p["lead"]
                    if lead is not None:
                        piece = piece[:lead] + piece[lead + core :]
                    rows.append((t1, t2, p["start"], p["n"], p["key"], p["hot"], lead, piece))
            columns = zip(*rows) if rows else [[]] * len(_PIECE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE
            )

    return run


def _parts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts of the listed stretches of each text, keyed by key, place of the key's string and core."""
        for batch in sized_slices(batches, 2, rows=256):
            rows, pieces, size = [], [], 0
            texts = batch.column(2).cast(pa.binary())
            for t1, t2, text, places in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(1), texts, batch.column(3)))):
                for p in places:
                    piece = text[p["start"] : p["start"] + p["n"] + length - 1]
                    rows.append((t1, t2, p["start"], p["n"], p["key"]))
                    pieces.append(piece)
                    size += len(piece)
                    if size > SLICE:
                        yield _part_rows(rows, pieces, length)
                        rows, pieces, size = [], [], 0
            if rows:
                yield _part_rows(rows, pieces, length)

    return run


def _part_rows(rows: list[tuple], pieces: list[bytes], length: int) -> pa.RecordBatch:
    t1, t2, start, n, key = (np.array(c, np.int64) for c in zip(*rows))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    begin = np.cumsum([0, *map(len, pieces)])[:-1]
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    h = span_hashes(prefix, at, at + GRAM)
    grams = (n + length - GRAM).tolist()
    anchor = np.array([a + int(np.argmin(h[a : a + g])) for a, g in zip(begin.tolist(), grams)], np.int64)
    # How far before its key's string a window starts, in the first and last window of the stretch.
    far, near = anchor - begin, anchor - (begin + n - 1)
    low, count = near // PART, far // PART - near // PART + 1
    row = np.repeat(np.arange(len(rows)), count)
    number = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    most, least = np.minimum(number * PART + PART - 1, far[row]), np.maximum(number * PART, near[row])
    first, windows = anchor[row] - most, most - least + 1
    core = span_hashes(prefix, anchor[row] - number * PART, anchor[row] - number * PART - PART + 1 + length)
    whole = span_hashes(prefix, first, first + windows + length - 1)
    group = mix(mix(core + number.astype(np.uint64)) ^ key[row].view(np.uint64))
    columns = [t1[row], t2[row], start[row] + first - begin[row], windows, group.view(np.int64), whole.view(np.int64)]
    arrays = [pa.array(c) for c in columns] + [pa.array(np.zeros(len(row), bool)), pa.array(most - number * PART)]
    return pa.RecordBatch.from_arrays(arrays, schema=_PART)


# Symbols that fit one 64-bit number, nine bits each.
PACK = 7
# Symbols above those of bytes, of which the numbers of cores are made.
FIRST_MARK, MARKS = 258, 254
# Borders with more suffixes than this up to the next border are extended symbol by symbol, others suffix by suffix.
WIDE = 64


def _packed(text: np.ndarray) -> np.ndarray:
    """The PACK symbols from each place on as one number; there are zeros after the end."""
    padded = np.concatenate([text.astype(np.uint64), np.zeros(PACK, np.uint64)])
    key = np.zeros(len(text), np.uint64)
    for k in range(PACK):
        key = (key << np.uint64(9)) | padded[k : k + len(text)]
    return key


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the length that is compared. Symbols are below 512.

    The last symbol must occur nowhere else. Suffixes that already differ from all others are not sorted again.
    """
    n = len(text)
    key = _packed(text)
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    depth = PACK
    rank = np.empty(n, np.int64)  # the first place of the suffixes that share the length compared so far
    while True:
        first = np.flatnonzero(new)
        rank[order] = np.repeat(first, np.diff(np.append(first, n)))
        open_ = np.flatnonzero(~(new & np.append(new[1:], True)))  # places that share their rank
        if not len(open_):
            return order
        own = order[open_]
        follow = np.where(own + depth < n, rank[np.minimum(own + depth, n - 1)], -1) + 1
        key = (rank[own].astype(np.uint64) << np.uint64(32)) | follow.astype(np.uint64)
        by = np.argsort(key)
        order[open_] = own[by]
        key = key[by]
        new[open_[1:]] |= key[1:] != key[:-1]
        depth *= 2


def shared_prefixes(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each place in the suffix order: whether it shares at least ``least`` symbols with the place before.

    Prefixes of a few symbols are read off the packed symbols. From there on, level by level, a border between two
    suffixes that share ``l`` symbols is extended backwards by every symbol: the next occurrence of the symbol in
    the transform leads to a border of ``l + 1``, unless a smaller one was found there before. What follows the next
    border that is known already needs no look: it is extended from there.
    """
    n = len(text)
    # Shared symbols of neighbours up to a depth of ``start``.
    packed, start = _packed(text), min(4 * PACK, least)
    shared = np.zeros(n, np.int64)
    equal = np.ones(n, bool)
    equal[0] = False
    for at in range(0, 4 * PACK, PACK):
        place = np.minimum(order + at, n - 1)
        differ = packed[place][1:] ^ packed[place][:-1]
        alike = np.zeros(n, np.int64)
        high = np.frexp(differ.astype(np.float64))[1]  # bits, perhaps one too many after rounding up
        high -= (differ >> np.uint64(1) < np.uint64(1) << np.maximum(high - 2, 0).astype(np.uint64)) & (high > 1)
        alike[1:] = np.where(differ == 0, PACK, PACK - 1 - (np.maximum(high, 1) - 1) // 9)
        shared += np.where(equal, alike, 0)
        equal[1:] &= differ == 0
    shared = np.minimum(shared, start)
    found = shared < start
    if start == least:
        return ~found
    # The transform: the symbol before each suffix, and the place of the suffix that starts with it.
    transform = text[order - 1]
    place_of = np.empty(n, np.int64)
    place_of[order] = np.arange(n)
    before = place_of[order - 1]
    by_symbol = np.argsort(transform, kind="stable")
    last = np.full(n, -1, np.int64)  # the last place before with the same symbol
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    last[by_symbol[1:][same]] = by_symbol[:-1][same]
    symbols, firsts = np.unique(transform[by_symbol], return_index=True)
    places = np.split(by_symbol, firsts[1:])
    border = np.flatnonzero(shared == start - 1)
    for _ in range(least - start):
        if not len(border):
            break
        known = np.flatnonzero(found)
        width = np.append(known, n)[np.searchsorted(known, border, side="right")] - border
        narrow = width <= WIDE
        near, size = border[narrow], width[narrow]
        at = np.repeat(near, size)
        look = at + np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        fresh = [before[look[last[look] < at]]]
        for own in places if not narrow.all() else []:
            to = np.searchsorted(own, border[~narrow])
            fresh.append(before[own[to[to < len(own)]]])
        border = np.unique(np.concatenate(fresh))
        border = border[~found[border]]
        found[border] = True
    return ~found


def _bucket_text(raw: list[bytes], lead: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of pieces end to end, and where each begins and ends; a row of marks stands after the lead of each.

    Bytes are 2 to 257, marks above, the one after a piece is 1, the end of the text 0.
    """
    lengths, width = np.array([len(b) for b in raw], np.int64), marks.shape[1]
    ends = np.cumsum(lengths + width + 1)
    begin = ends - lengths - width - 1
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.repeat(begin, lengths) + within + width * (within >= np.repeat(lead, lengths))
    text = np.zeros(ends[-1] + 1, np.int64)
    text[at] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64) + 2
    text[(begin + lead)[:, None] + np.arange(width)] = marks
    text[ends - 1] = 1
    return text, begin, ends


def _core_marks(key: np.ndarray) -> np.ndarray:
    """Symbols above those of bytes that number the keys, as many for each."""
    names, number = np.unique(key, return_inverse=True)
    width = 1
    while MARKS**width < len(names):
        width += 1
    return FIRST_MARK + number[:, None] // MARKS ** np.arange(width)[::-1] % MARKS


def _compare(table_: pa.Table, length: int) -> pa.Table:
    """Spans of the windows of a bucket's pieces that occur at two places of the bucket."""
    cored = table_.column("lead").is_valid()
    kinds = [table_.filter(cored), table_.filter(pc.invert(cored))]
    return pa.concat_tables([_compare_kind(t, length) for t in kinds if len(t)])


def _compare_kind(table_: pa.Table, length: int) -> pa.Table:
    """Spans of repeated windows among pieces that are all whole, or all without their cores."""
    raw = table_.column("bytes").to_pylist()
    n = table_.column("n").to_numpy()
    if table_.column("lead").null_count:
        lead, marks, least = np.zeros(len(raw), np.int64), np.zeros((len(raw), 0), np.int64), length
    else:
        # A window of a part holds the whole core, so equal ones have it at the same place.
        lead, marks = table_.column("lead").to_numpy(), _core_marks(table_.column("key").to_numpy())
        least = PART - 1 + marks.shape[1]
    text, begin, ends = _bucket_text(raw, lead, marks)
    order = suffix_order(text)
    same = shared_prefixes(text, order, least)
    again = np.zeros(len(text), bool)
    places = np.flatnonzero(same)
    again[order[places]] = True
    again[order[places - 1]] = True
    # Only windows count, not what runs over the end of a piece.
    inside = np.zeros(len(text) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, begin + n, -1)
    again &= np.cumsum(inside[:-1]) > 0
    edge = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    from_, to = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(begin, from_, side="right") - 1
    start = table_.column("start").to_numpy()[row]
    return pa.table(
        {
            "t1": pa.array(table_.column("t1").to_numpy()[row]),
            "t2": pa.array(table_.column("t2").to_numpy()[row]),
            "start": pa.array(start + from_ - begin[row]),
            "end": pa.array(start + to - begin[row] + length - 1),
        }
    )


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the hashed strings of all given stretches, one row for each run of counters that is not empty."""
    total = np.zeros(COUNTERS, np.int64)
    for batch in sized_slices(batches, 0, size=SLICE):
        data, starts = text_bytes(batch.column(0))
        at = np.arange(max(0, len(data) - GRAM + 1))
        at = at[np.searchsorted(starts, at, side="right") == np.searchsorted(starts, at + GRAM - 1, side="right")]
        h = span_hashes(prefix_hashes(data), at, at + GRAM)
        total += np.bincount((h % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    rows = total.reshape(-1, CHUNK)
    full = np.flatnonzero(rows.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(full), pa.array([rows[k].astype("<i8").tobytes() for k in full], pa.binary())], names=["chunk", "counts"]
    )


def _add(table_: pa.Table) -> pa.Table:
    counts = sum(np.frombuffer(b, "<i8") for b in table_.column("counts").to_pylist())
    return pa.table({"chunk": table_.column("chunk").slice(0, 1), "counts": pa.array([counts.tobytes()], pa.binary())})


def _rekey(counts: np.ndarray, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches, 3, size=SLICE):
            data, starts = text_bytes(batch.column(3))
            row, start, n, key, content, inner = stretches(data, starts, length, counts)
            t1, t2, base = (batch.column(k).to_numpy()[row] for k in range(3))
            columns = [t1, t2, base + start, n, key, content, inner]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_STRETCH)

    return run


def _collapsed(windows: DataFrame) -> DataFrame:
    """Each different stretch once, with its least place, whether it has another, and the lead of a part."""
    place = F.struct("t1", "t2", "start")
    grouped = windows.groupBy("key", "content", "n")
    lead = F.max("lead") if "lead" in windows.columns else F.lit(None).cast("long")
    return grouped.agg(
        F.min(place).alias("place"), F.max(place).alias("other"), F.max("inner").alias("inner"), lead.alias("lead")
    ).select("key", "content", "n", "place", (F.col("place") != F.col("other")).alias("again"), "inner", "lead")


def _open_keys(classes: DataFrame, length: int) -> DataFrame:
    """Keys with several different stretches or one that may repeat within, seen once only, and their bytes."""
    return (
        classes.groupBy("key")
        .agg(F.count("*").alias("contents"), F.sum(F.col("n") + length - 1).alias("key_bytes"), F.min("again").alias("all_again"), F.max("inner").alias("inner"))
        .filter("(contents > 1 or inner) and not all_again")
        .select("key", "key_bytes", F.col("inner").alias("inner_key"))
    )


def _whole(windows: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """Spans of the stretches that occur at two places."""
    return windows.join(classes.filter("again").select("key", "content", "n"), ["key", "content", "n"]).select(
        "t1", "t2", "start", (F.col("start") + F.col("n") + length - 1).alias("end")
    )


def _compared(pieces: DataFrame, length: int) -> DataFrame:
    """Spans found by comparing the stretches of each key; keys share buckets of about BUCKET_BYTES."""
    total = pieces.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_BYTES))
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
    # Few bytes take long to compare, so buckets are not drawn together into fewer tasks.
    spread = min(buckets, 4 * shuffle_width(pieces.sparkSession))
    compare = lambda table_: _compare(table_, length)
    return pieces.withColumn("bucket", bucket).repartition(spread, "bucket").groupBy("bucket").applyInArrow(compare, SPAN)


def _listed(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """One copy of each text (t1, t2, text) that holds wanted stretches (place, n, key, hot, lead), with their list."""
    lists = wanted.groupBy(F.col("place.t1").alias("t1"), F.col("place.t2").alias("t2")).agg(
        F.collect_list(F.struct(F.col("place.start").alias("start"), "n", "key", "hot", "inner", "lead")).alias("places")
    )
    found = texts.join(lists, ["t1", "t2"]).dropDuplicates(["t1", "t2"])
    return found.select("t1", "t2", "text", "places")


def _open(classes: DataFrame, length: int) -> DataFrame:
    """Stretches of open keys: place, n, key, whether the key is hot, whether one of its stretches may repeat within, and lead."""
    return classes.join(_open_keys(classes, length), "key").select(
        "place", "n", "key", (F.col("key_bytes") > HOT_BYTES).alias("hot"), F.col("inner_key").alias("inner"), "lead"
    )


def _least_bytes(words: int | None) -> int:
    """Bytes that a text holding a window has at least."""
    return LENGTH if words is None else 2 * words - 1


def repeated_spans(documents: DataFrame, words: int | None = None) -> DataFrame:
    """Spans (t1, t2, start, end) of the bytes of different texts, named by two hashes, that are to go.

    With ``words`` windows are that many words, and places are counted in bytes of the numbers of words. Spans may overlap.
    A text that several rows hold is listed once; what its copies mean is left to the caller.
    """
    length = LENGTH if words is None else words * WORD_BYTES
    texts = documents.select(*text_key(), F.col("text").cast("string").alias("text")).filter(
        F.octet_length("text") >= _least_bytes(words)
    )
    windows = stored(texts.mapInArrow(_windows(length, words is not None), STRETCH), "stretches")
    classes = stored(_collapsed(windows), "stretch-classes")
    # Only these texts are looked at again.
    involved = _listed(texts, _open(classes, length))
    if words is not None:
        involved = involved.mapInArrow(_coded, involved.withColumn("text", F.col("text").cast("binary")).schema)
    involved = stored(involved, "involved")
    plain = involved.withColumn("places", F.filter("places", lambda p: ~p["inner"])).filter(F.size("places") > 0)
    inner = involved.withColumn("places", F.filter("places", lambda p: p["inner"])).filter(F.size("places") > 0)
    parts = stored(plain.mapInArrow(_parts(length), PART_ROW), "parts")
    part_classes = stored(_collapsed(parts), "part-classes")
    left = _listed(involved.select("t1", "t2", "text"), _open(part_classes, length))
    cut = _cut(length)
    pieces = stored(left.mapInArrow(cut, PIECE).unionAll(inner.mapInArrow(cut, PIECE)), "pieces")
    spans = (
        _whole(windows, classes, length)
        .unionAll(_whole(parts, part_classes, length))
        .unionAll(_compared(pieces.filter("not hot"), length))
    )
    hot = pieces.filter("hot")
    if hot.isEmpty():
        return spans
    # The sketch has a fixed size, COUNTERS numbers, however much it counts.
    counted = hot.select("bytes").mapInArrow(_sketch, "chunk long, counts binary")
    counts = np.zeros(COUNTERS, np.int64)
    for row in counted.groupBy("chunk").applyInArrow(_add, "chunk long, counts binary").collect():
        counts[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], "<i8")
    rekey = _rekey(counts.astype(np.float32), length)
    again = stored(hot.select("t1", "t2", "start", "bytes").mapInArrow(rekey, STRETCH), "stretches")
    finer = stored(_collapsed(again), "stretch-classes")
    rest = _listed(involved.select("t1", "t2", "text"), _open(finer, length))
    compared = _compared(stored(rest.mapInArrow(cut, PIECE), "pieces"), length)
    return spans.unionAll(_whole(again, finer, length)).unionAll(compared)


def _runs(spans: DataFrame) -> DataFrame:
    """Per text (t1, t2) the runs that its spans make when those that touch or overlap are joined, in order."""
    order = Window.partitionBy("t1", "t2").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    numbered = spans.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order))
    joined = numbered.groupBy("t1", "t2", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return joined.groupBy("t1", "t2").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def _inside_character(data: Column, place: Column) -> Column:
    """Whether the byte at a place continues a UTF-8 character."""
    return F.hex(F.substring(data, place + 1, F.lit(1))).between("80", "BF")


def _whole_characters(data: Column, run: Column) -> Column:
    """A run narrowed to whole characters, of which none has more than four bytes."""
    start, end = run["start"], run["end"]
    ahead = lambda k: _inside_character(data, start + k)
    behind = lambda k: _inside_character(data, end - k)
    first = F.when(~ahead(0), 0).when(~ahead(1), 1).when(~ahead(2), 2).otherwise(3)
    last = F.when(~behind(0), 0).when(~behind(1), 1).when(~behind(2), 2).otherwise(3)
    return F.struct((start + first).alias("start"), (end - last).alias("end"))


def _kept(data: Column, size: Column, runs: Column) -> Column:
    """The bytes between the runs, end to end."""
    edge = lambda k: F.when(k > 0, F.get(runs, k - 1)["end"]).otherwise(0)
    until = lambda k: F.when(k < F.size(runs), F.get(runs, k)["start"]).otherwise(size)
    piece = lambda k: F.substring(data, (edge(k) + 1).cast("int"), (until(k) - edge(k)).cast("int"))
    return F.aggregate(
        F.sequence(F.lit(0), F.size(runs)), F.lit(b""), lambda kept, k: F.concat(kept, piece(k))
    )


def _marks(documents: DataFrame, words: int | None = None) -> DataFrame:
    """Per text (t1, t2) that has any: its ``runs``, and whether several rows hold it."""
    spans = repeated_spans(documents, words)
    long = documents.select(*text_key()).filter(F.octet_length(F.col("text").cast("string")) >= _least_bytes(words))
    copies = long.groupBy("t1", "t2").count().filter("count > 1").select("t1", "t2", F.lit(True).alias("copied"))
    return copies.join(_runs(spans), ["t1", "t2"], "full")


def _word_marks(documents: DataFrame, words: int) -> DataFrame:
    """Per text (t1, t2) the ``passages`` (start, end) that repeat, in words; of copied texts as much as they hold."""
    # Bytes of a word that chance makes equal do not count.
    place = lambda r: F.struct(
        F.ceil(r["start"] / WORD_BYTES).alias("start"), F.floor(r["end"] / WORD_BYTES).alias("end")
    )
    runs = F.filter(F.transform("runs", place), lambda r: r["end"] - r["start"] >= words)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit((1 << 62)).alias("end")))
    marks = _marks(documents, words).select("t1", "t2", F.when(F.col("copied"), whole).otherwise(runs).alias("passages"))
    return marks.filter(F.size("passages") > 0)


def _with_passages(words: int) -> Callable[..., Column]:
    """The byte runs of a text and its passages of words as byte runs, those that touch or overlap joined."""

    def joined(text: bytes, runs: list[dict], passages: list[dict]) -> list[tuple[int, int]]:
        data = np.frombuffer(text, np.uint8)
        first, last, _ = word_spans(data, np.array([0, len(data)]))
        spans = [(r["start"], r["end"]) for r in runs]
        for p in passages:
            end = min(p["end"], len(first))
            if end - p["start"] >= words:
                spans.append((int(first[p["start"]]), int(last[end - 1])))
        out: list[tuple[int, int]] = []
        for start, end in sorted(spans):
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], max(end, out[-1][1]))
            else:
                out.append((start, end))
        return out

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf(RUNS)
    def run(text: pa.Array, runs: pa.Array, passages: pa.Array) -> pa.Array:
        rows = zip(text.cast(pa.binary()), runs, passages)
        lists = (joined(t.as_py(), r.as_py(), p.as_py()) if p.is_valid else None for t, r, p in rows)
        return pa.array([x and [{"start": a, "end": b} for a, b in x] for x in lists], kind)

    return run


def _crowded(documents: DataFrame) -> list[int]:
    """The slots of texts that hold many times their share of the rows; there are at most SLOTS / CROWD of them."""
    slot = F.pmod(text_key()[0], F.lit(SLOTS)).alias("slot")
    sizes = documents.select(slot).groupBy("slot").count()
    rows = sizes.agg(F.sum("count")).first()[0] or 0
    return [r["slot"] for r in sizes.filter(F.col("count") > max(CROWD * rows / SLOTS, CROWD)).collect()]


def remove_repeats(
    documents: DataFrame, as_text: bool = False, prefix: str = "_", words: int | None = None
) -> DataFrame:
    """The given rows without text, with ``_n_bytes``, ``_n_removed``, ``_runs`` (start, end) and the ``_kept`` bytes.

    Needs text; a null text is empty. Every byte goes that lies in a 400-byte string which starts at another place too,
    of the same text or another; all are judged on the input. Rows that repeat a text of 400 bytes or more lose all of
    it. Texts below 400 bytes stay. With ``words`` (16 or more) every stretch of that many words which starts at another
    place too goes as well, however few bytes it has. With ``as_text`` runs are narrowed to whole characters, so that what
    is kept is text. Other columns pass through; none may start with the ``prefix`` of the new ones.
    """
    spark = documents.sparkSession
    if words is not None and words * WORD_BYTES < GRAM + PART:
        raise ValueError(f"words must be {(GRAM + PART) // WORD_BYTES} or more")
    with scratch(spark):
        marks = stored(_marks(documents), "repeat-marks", outlives=True)
    if words is not None:
        with scratch(spark):
            passages = stored(_word_marks(documents, words), "passage-marks", outlives=True)
        marks = marks.join(passages, ["t1", "t2"], "full")
    name = lambda c: f"{prefix}{c}"
    of = lambda c: F.col(name(c))
    # The copies of a text are many rows of one key: in crowded slots they are dealt over parts, and the marks repeated.
    crowded = F.array(*map(F.lit, _crowded(documents))).cast("array<bigint>")
    in_crowd = lambda key: F.array_contains(crowded, F.pmod(key, F.lit(SLOTS)))
    parts = F.when(in_crowd(F.col("t1")), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = marks.select(
        *[F.col(c).alias(name(c)) for c in marks.columns if c != "runs"],
        F.col("runs").alias(name("found")),
        F.explode(parts).alias(name("part")),
    )
    others = [F.col(f"`{c}`") for c in documents.columns if c.lower() != "text"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own_part = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int")
    named = documents.select(
        *others, text.cast("binary").alias(name("bytes")), *[k.alias(name(n)) for k, n in zip(text_key(), ("t1", "t2"))]
    ).withColumn(name("part"), F.when(in_crowd(of("t1")), own_part).otherwise(0))
    named = named.withColumn(name("n_bytes"), F.octet_length(of("bytes")).cast("long"))
    nothing = F.array().cast(RUNS)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), of("n_bytes").alias("end")))
    found = F.when(of("copied"), everything).otherwise(F.coalesce(of("found"), nothing))
    marked = named.join(dealt, [name(c) for c in ("t1", "t2", "part")], "left").withColumn(name("runs"), found)
    if words is not None:
        # Only texts that hold passages go through Python.
        holds = of("passages").isNotNull()
        both = _with_passages(words)(F.when(holds, of("bytes")), F.when(holds, of("runs")), of("passages"))
        marked = marked.withColumn(name("both"), both).withColumn(name("runs"), F.coalesce(of("both"), of("runs")))
    if as_text:
        narrow = F.transform(of("runs"), lambda r: _whole_characters(of("bytes"), r))
        marked = marked.withColumn(name("runs"), F.filter(narrow, lambda r: r["start"] < r["end"]))
    removed = F.aggregate(of("runs"), F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    kept = _kept(of("bytes"), of("n_bytes"), of("runs"))
    return marked.select(*others, of("n_bytes"), removed.alias(name("n_removed")), of("runs"), kept.alias(name("kept")))


def op4_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    """What is removed from every document, and the hash of what is left."""
    rows = remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        F.col("_n_bytes").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.size("_runs").cast("long").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
        (F.col("_n_bytes") - F.col("_n_removed")).alias("n_kept"),
        (F.col("_n_removed") > 0).alias("has_repeats"),
    )


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: every document without the strings and passages that repeat, and with its new length.

    Strings of 400 bytes go, and passages of PASSAGE_WORDS words or more, however few bytes they have. Runs are narrowed to whole characters, so that what is left is text. A document of which nothing is left stays, empty;
    a null text becomes empty.
    """
    prefix = free_name(docs.columns, "_")
    left = remove_repeats(docs, as_text=True, prefix=prefix, words=PASSAGE_WORDS)
    text = F.decode(F.col(f"{prefix}kept"), "UTF-8")
    columns = {"text": text, "n_chars": F.length(text).cast("long")}
    return left.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


OP4_SQL = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, piece + pos AS pos, md5_number(substr(h, 2 * pos + 1, 800)) AS content
  FROM (
    SELECT doc_id, piece, part AS h, unnest(range(0, len(part) // 2 - 399)) AS pos
    FROM (
      SELECT doc_id, piece, substr(h, 2 * piece + 1, 2 * (1024 + 399)) AS part
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399, 1024)) AS piece FROM t WHERE len(h) >= 800)))),
g AS (SELECT content FROM w GROUP BY 1 HAVING count(*) > 1),
m AS (SELECT doc_id, pos FROM w SEMI JOIN g ON w.content = g.content),
o AS (SELECT doc_id, pos, CASE WHEN pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 400 THEN 1 ELSE 0 END AS opens FROM m),
u AS (SELECT doc_id, pos, sum(opens) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM o),
s AS (SELECT doc_id, run, min(pos) AS start, max(pos) + 400 AS stop FROM u GROUP BY 1, 2),
p AS (
  SELECT s.doc_id, start, stop, coalesce(lag(stop) OVER (PARTITION BY s.doc_id ORDER BY start), 0) AS since FROM s),
k AS (
  SELECT t.doc_id, any_value(h) AS h, coalesce(sum(stop - start), 0)::BIGINT AS n_removed, count(start) AS n_spans,
    coalesce(string_agg(substr(h, 2 * since + 1, 2 * (start - since)), '' ORDER BY start), '')
      || substr(any_value(h), 2 * coalesce(max(stop), 0) + 1) AS rest
  FROM t LEFT JOIN p ON p.doc_id = t.doc_id GROUP BY t.doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(rest)) AS kept_sha256,
  (len(h) // 2)::BIGINT - n_removed AS n_kept, n_removed > 0 AS has_repeats
FROM k
"""
