"""Token ids of a corpus as ORC files.

Texts are encoded and written in ascending order of doc_id: the rows are dealt by ranges of the id, so each file holds a range
and its row groups narrow ones. In the files

* ids are integer lists, which ORC stores by integer run-length encoding, as all numbers beside them;
* a stripe is a unit that a task can read on its own, so one large file is read by many tasks;
* a row index keeps the least and greatest doc_id of every few rows, and a Bloom filter tells for almost all absent ids
  that a row group lacks them. A read by id opens only the row groups that may hold it.

Every row knows its file's number and the ids before it in that file. A second, small table holds the ids of each file, whose
running sum places a document in the whole stream.

Every distinct word of a batch is encoded once, and a worker remembers the words it has met; white space is dropped by the
vocabulary, so the ids of a text are those of its words.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from reelstat.llm.common import kept_by_worker, prefix_hashes, sized_slices, span_hashes, table, text_bytes, word_spans
from reelstat.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
# Bytes of a stripe, rows of an index entry, and the share of absent ids that a Bloom filter lets through.
STRIPE_BYTES, INDEX_ROWS, FALSE_HITS = 16 << 20, 1000, 0.01
# Words a worker remembers, how many of them may have been met lately, and words that are encoded as one text.
REMEMBERED, RECENT, TOGETHER = 1 << 21, 1 << 16, 2048
# Bytes of text that are encoded at once.
SLICE = 1 << 20

ROW = "doc_id long, part int, before long, n_tokens long, ids array<int>"
PART = "part int, n_rows long, n_tokens long"
_ROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("part", pa.int32()),
        ("before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


class _Index:
    """Hashes of words in order, where each word's ids start and how many there are, and which were asked for."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.asked = np.zeros(0, bool)

    def add(self, hashes: np.ndarray, first: np.ndarray, count: np.ndarray, asked: np.ndarray) -> None:
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.first = np.insert(self.first, at, first)
        self.count = np.insert(self.count, at, count)
        self.asked = np.insert(self.asked, at, asked)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are held, and the places of these."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        held = self.hashes[at] == hashes
        return held, at[held]


class Words:
    """The ids of words, encoded once each and found again by the 64-bit hash of their bytes."""

    # A word between marks that the vocabulary joins with no other.
    MARK = "\x00"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        # Words met lately are few, so that they are put in order quickly; they join the others by and by.
        self.known, self.recent = _Index(), _Index()
        self.ids = np.zeros(0, np.int32)

    def _joint(self, words: list[str], between: str) -> np.ndarray:
        """The ids of many words that are encoded as a few long texts."""
        texts = [between.join(words[k : k + TOGETHER]) + between for k in range(0, len(words), TOGETHER)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(found), np.int32, sum(map(len, found)))

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words end to end, and how many each has.

        A word of ASCII letters is one piece to the vocabulary, whose last id ends a piece. Others may be several, and are
        set apart by marks; those that hold the mark are encoded one by one.
        """
        kind = np.array([0 if w.isascii() and w.isalpha() else 1 if self.MARK not in w else 2 for w in words], np.int8)
        letters, marked, odd = (np.flatnonzero(kind == k) for k in range(3))
        one = self._joint([words[k] for k in letters], " ")
        ends = np.flatnonzero(self.closes[one])
        two = self._joint([words[k] for k in marked], f" {self.MARK} ")
        marks = np.flatnonzero(two == self.mark)
        own = [self.tokenizer.encode(words[k], add_special_tokens=False).ids for k in odd]
        counts = np.zeros(len(words), np.int64)
        counts[letters] = np.diff(ends, prepend=-1)
        counts[marked] = np.diff(marks, prepend=-1) - 1
        counts[odd] = [len(ids) for ids in own]
        # The three kinds end to end, and from there in the order of the words.
        flat = np.concatenate([one, two[two != self.mark], *[np.array(ids, np.int32) for ids in own]])
        order = np.concatenate([letters, marked, odd])
        begin = np.zeros(len(words), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        stops = np.cumsum(counts)
        return flat[np.repeat(begin - (stops - counts), counts) + np.arange(len(flat))], counts

    def _trim(self) -> None:
        """Join the words met lately with the others; of too many, keep those asked for since the last time."""
        new = self.recent
        self.known.add(new.hashes, new.first, new.count, new.asked)
        self.recent = _Index()
        if len(self.known.hashes) <= REMEMBERED:
            return
        old, self.known = self.known, _Index()
        keep = np.flatnonzero(old.asked)
        keep = keep if len(keep) <= REMEMBERED // 2 else keep[:0]
        count = old.count[keep]
        first = np.cumsum(count) - count
        self.ids = self.ids[np.repeat(old.first[keep] - first, count) + np.arange(count.sum())]
        self.known.add(old.hashes[keep], first, count, np.zeros(len(keep), bool))

    def look_up(self, raw: bytes, first: np.ndarray, last: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word stand in ``ids``, and how many there are. The hashes are distinct and in order."""
        if len(self.recent.hashes) > RECENT:
            self._trim()
        begin, many = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        new = np.ones(len(hashes), bool)
        for index in (self.known, self.recent):
            held, at = index.find(hashes)
            begin[held], many[held] = index.first[at], index.count[at]
            index.asked[at] = True
            new &= ~held
        if new.any():
            spans = zip(first[new].tolist(), last[new].tolist())
            flat, counts = self._encode([raw[a:b].decode() for a, b in spans])
            begin[new], many[new] = len(self.ids) + np.cumsum(counts) - counts, counts
            self.recent.add(hashes[new], begin[new], counts, np.zeros(len(counts), bool))
            self.ids = np.concatenate([self.ids, flat])
        return begin, many


def encode(path: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of whole texts, each with the end id, end to end, and how many each text has. A null text is empty."""
    words = kept_by_worker(f"words of {path}", lambda: Words(path))
    data, starts = text_bytes(column)
    n = len(starts) - 1
    first, last, rows = word_spans(data, starts)
    hashes, pick, which = np.unique(span_hashes(prefix_hashes(data), first, last), return_index=True, return_inverse=True)
    begin, many = words.look_up(data.tobytes(), first[pick], last[pick], hashes)
    # The end id is one more word, last in every text.
    begin, many = np.append(begin, len(words.ids)), np.append(many, 1)
    ids = np.append(words.ids, np.int32(END_ID))
    per_row = np.bincount(rows, minlength=n)
    order = np.insert(which, np.cumsum(per_row), len(many) - 1)
    begin, many = begin[order], many[order]
    ends = np.cumsum(many)
    flat = ids[np.repeat(begin - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)]
    stops = ends[np.cumsum(per_row + 1) - 1] if n else np.zeros(0, np.int64)
    return flat, np.diff(stops, prepend=0)


def _rows(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in sized_slices(batches, 1, size=SLICE):
            flat, counts = encode(path, batch.column(1))
            ends = np.cumsum(counts)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat))
            columns = [batch.column(0), pa.array(np.full(len(counts), part, np.int32)), pa.array(before + ends - counts)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts), lists], schema=_ROW)
            before += int(ends[-1]) if len(ends) else 0

    return rows


def write_ids(documents: DataFrame, folder: str, tokenizer: str) -> None:
    """Encode all texts and write their ids under ``folder``, which must not exist.

    Needs doc_id and text; other columns are ignored. A null text is empty and has the end id only. Rows without doc_id
    come first; rows that share an id follow each other, equal texts together, and each is written.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The row's place in the scan parts equal rows, so that no range grows with the copies of one.
    tie = [F.xxhash64("text").alias("_same"), F.monotonically_increasing_id().alias("_row")]
    dealt = docs.select("doc_id", "text", *tie).repartitionByRange("doc_id", "_same", "_row")
    ordered = dealt.sortWithinPartitions("doc_id", "_same", "_row").select("doc_id", "text")
    writer = ordered.mapInArrow(_rows(tokenizer), ROW).write
    settings = {
        "orc.stripe.size": STRIPE_BYTES,
        "orc.row.index.stride": INDEX_ROWS,
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": FALSE_HITS,
        "compression": "zstd",
    }
    writer.options(**{k: str(v) for k, v in settings.items()}).orc(f"{folder}/ids")
    written = _written(documents.sparkSession, folder)
    totals = written.groupBy("part").agg(
        F.count("*").alias("n_rows"), F.max(F.col("before") + F.col("n_tokens")).alias("n_tokens")
    )
    totals.write.orc(f"{folder}/parts")


def _written(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ROW).orc(f"{folder}/ids")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every written row: doc_id, start (ids of all rows before it), n_tokens and ids.

    A condition on doc_id reaches the files, where index and Bloom filter leave row groups out; columns not asked
    for are not read.
    """
    parts = spark.read.schema(PART).orc(f"{folder}/parts")
    # One row for each file.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)).alias("first"))
    both = _written(spark, folder).join(starts, "part")
    return both.select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        ids = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<u4")
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends, data = np.cumsum(lengths), memoryview(ids).cast("B")
        sums = [zlib.crc32(data[4 * (b - n) : 4 * b]) for n, b in zip(lengths.tolist(), ends.tolist())]
        columns = [batch.column(0), batch.column(1), pa.array(lengths), pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def checked(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit numbers, of every written row."""
    rows = read_ids(spark, folder).select("doc_id", "start", "ids")
    return rows.mapInArrow(_summed, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Write the ids of all documents as ORC, read them back, and tell where each document lies and its checksum."""
    target = scratch_path(spark, "token-ids")
    write_ids(table(spark, folder, "documents"), target, public_tokenizers.path(VOCABULARY))
    return checked(spark, target)
