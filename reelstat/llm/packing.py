"""Pack documents into token sequences of bounded length.

A dynamic program chooses where sequences end. The documents of a partition form one stream of tokens in
their stored order. A sequence may end at a document's end for nothing, at a sentence's end for a
small penalty, and elsewhere, where sentences are very long, for a larger one; each sequence also pays for its
padding. The cheapest way to end at ``j`` is

    best(j) = penalty(j) + capacity - j + min(best(i) + i  for j - capacity <= i < j)

and the minimum slides, so a queue kept in increasing order of ``best(i) + i`` gives every step in constant time.
Nothing is shuffled: each partition of the scan packs its own documents, and only its last sequence can be short.
That one is cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from reelstat.llm.common import kept_by_worker, prefix_hashes, sized_slices, span_hashes, table, text_bytes

CAPACITY = 2048
END_ID = 1
SENTENCE_PENALTY = 2
ANYWHERE_PENALTY = 8
# Where no sentence ends for so many tokens, a cut is allowed every so many tokens.
LONG_SENTENCE = 16
# Bytes of text that are encoded at once.
SLICE = 2 << 20
# Tokens that one run of the dynamic program looks at; its last sequence is carried into the next run.
STRETCH = 1 << 19
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


class _Codec(NamedTuple):
    # A byte-level encoder with the vocabulary of a tokenizer file, and which ids end a sentence.
    encoder: tiktoken.Encoding
    ends: np.ndarray
    # The file's own tokenizer, and the strings that it turns into ids beside the vocabulary.
    tokenizer: Tokenizer
    added: list[str]


def _codec(path: str) -> _Codec:
    return kept_by_worker(f"codec of {path}", lambda: _new_codec(path))


def _new_codec(path: str) -> _Codec:
    """The file's merges in order are the ranks of the encoder, so both give the same ids for texts without added strings."""
    tokenizer = Tokenizer.from_file(path)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    ranks = {}
    for word, number in vocabulary.items():
        if all(c in byte_of for c in word) and not word.startswith("<|"):
            ranks[bytes(byte_of[c] for c in word)] = number
    encoder = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ends = np.zeros(max(max(vocabulary.values()), END_ID) + 1, bool)
    for word, number in ranks.items():
        ends[number] = word.rstrip(b" ").endswith((b".", b"!", b"?")) or b"\n" in word
    return _Codec(encoder, ends, tokenizer, added)


# A character that no entry of the vocabulary joins with others, and a line feed: the mark between words.
_MARK = "\x00\n"


def _packed(ids: list[int]) -> np.ndarray:
    return np.array(ids, np.uint32)


def _splittable(data: np.ndarray, starts: np.ndarray, at_break: np.ndarray) -> np.ndarray:
    """Rows whose text may be encoded word by word.

    In the pattern of the vocabulary a blank or line feed starts a piece and never ends one with a word, unless it
    lies in a run of three or more, or of two or more at the end of the text, or beside other white space.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    one, two = padded[1 : n + 1], padded[2 : n + 2]
    odd = (data < 32) & (data != 10)
    odd |= (data == 0xC2) & ((one == 0x85) | (one == 0xA0))
    odd |= (data == 0xE1) & (one == 0x9A) & (two == 0x80)
    wide = (two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF)
    odd |= (data == 0xE2) & ((one == 0x80) & wide | (one == 0x81) & (two == 0x9F))
    odd |= (data == 0xE3) & (one == 0x80) & (two == 0x80)
    ends = starts[1:]
    odd[:-2] |= at_break[:-2] & at_break[1:-1] & at_break[2:]
    last = ends[ends > starts[:-1] + 1]
    odd[last - 1] |= at_break[last - 1] & at_break[last - 2]
    count = np.concatenate([[0], np.cumsum(odd)])
    return count[ends] == count[starts[:-1]]


def encode(path: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of whole texts, each with the end id, end to end, and how many each text has.

    Every distinct word of the batch, with the blank or line feed before it, is encoded once.
    Words count as equal when their 64-bit hashes and lengths are. Texts that hold an added string are encoded whole.
    """
    encoder, _, tokenizer, added = _codec(path)
    data, starts = text_bytes(column)
    n_rows = len(starts) - 1
    at_break = (data == 32) | (data == 10)
    simple = _splittable(data, starts, at_break) if len(data) else np.ones(n_rows, bool)
    special = np.zeros(n_rows, bool)
    for token in added:
        special |= pc.match_substring(column, token).fill_null(False).to_numpy(zero_copy_only=False)
    simple &= ~special
    if not simple.all():
        at_break &= np.repeat(simple, np.diff(starts))
    at_break[starts[:-1][starts[:-1] < len(data)]] = True
    first = np.flatnonzero(at_break)
    last = np.append(first[1:], len(data))
    _, pick, which = np.unique(
        span_hashes(prefix_hashes(data), first, last), return_index=True, return_inverse=True
    )
    raw = data.tobytes()
    row_of = np.searchsorted(starts, first[pick], side="right") - 1
    alone = ~simple[row_of] if n_rows else np.zeros(0, bool)
    spans = zip(first[pick].tolist(), last[pick].tolist(), alone.tolist())
    words = ["" if skip else raw[a:b].decode() + _MARK for a, b, skip in spans]
    joined = _packed(encoder.encode_ordinary("".join(words)))
    stops = np.flatnonzero(joined == encoder.encode_ordinary(_MARK)[0])
    begin = np.zeros(len(pick), np.int64)
    length = np.zeros(len(pick), np.int64)
    begin[~alone] = np.concatenate([[0], stops[:-1] + 2]) if len(stops) else 0
    length[~alone] = stops - begin[~alone]
    parts, used = [joined, _packed([END_ID])], len(joined) + 1
    for k in np.flatnonzero(alone):
        text = raw[first[pick[k]] : last[pick[k]]].decode()
        if special[row_of[k]]:
            whole = _packed(tokenizer.encode(text, add_special_tokens=False).ids)
        else:
            whole = _packed(encoder.encode_ordinary(text))
        parts.append(whole)
        begin[k], length[k] = used, len(whole)
        used += len(whole)
    pool = np.concatenate(parts)
    # The end id follows the last word of each row.
    rows = np.searchsorted(starts, first, side="right") - 1
    at = np.searchsorted(rows, np.arange(n_rows), side="right")
    begins = np.insert(begin[which], at, len(joined))
    lengths = np.insert(length[which], at, 1)
    offset = np.cumsum(lengths) - lengths
    ids = pool[np.repeat(begins - offset, lengths) + np.arange(int(lengths.sum()))]
    return ids, np.bincount(np.insert(rows, at, np.arange(n_rows)), lengths, n_rows).astype(np.int64)


def cut(
    places: np.ndarray, penalties: np.ndarray, capacity: int = CAPACITY, free_end: bool = False
) -> list[int]:
    """Indexes of the chosen places: the cheapest chain from the first to the last place.

    Neighbouring places must be at most ``capacity`` apart. With ``free_end`` the last sequence pays for no padding.
    """
    price = (penalties + capacity).tolist()
    back, totals = [0], [int(places[0])]
    value = int(places[0])  # best(i) + place(i) of the newest place
    queue, values, ends = [], [], []  # places that may start a sequence, their values, the last place they reach
    head = 0
    for j, (place, last) in enumerate(zip(places.tolist()[1:], (places + capacity).tolist()), 1):
        while len(values) > head and values[-1] >= value:
            values.pop(), queue.pop(), ends.pop()
        values.append(value), queue.append(j - 1), ends.append(last)
        while ends[head] < place:
            head += 1
        back.append(queue[head])
        value = values[head] + price[j]
        totals.append(value)
    if free_end and len(places) > 1:
        low = int(np.searchsorted(places, places[-1] - capacity))
        back[-1] = low + int(np.argmin(np.array(totals[low:-1]) - places[low:-1]))
    chain = [len(places) - 1]
    while chain[-1]:
        chain.append(back[chain[-1]])
    return chain[::-1]


def _places(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a sequence may end in a stretch of tokens, and for which penalty."""
    price = np.zeros(len(ids) + 1, np.uint8)  # 0: no place; else one more than the penalty
    price[1:] = ends[ids] * np.uint8(SENTENCE_PENALTY + 1)
    price[doc_ends] = 1
    price[[0, -1]] = 1
    fixed = np.flatnonzero(price)
    gaps, step = np.diff(fixed), min(LONG_SENTENCE, capacity)
    more = (gaps - 1) // step
    first = np.repeat(fixed[:-1], more)
    count = np.arange(len(first)) - np.repeat(np.cumsum(more) - more, more) + 1
    price[first + count * step] = ANYWHERE_PENALTY + 1
    places = np.flatnonzero(price)
    return places, price[places].astype(np.int64) - 1


def _binary_cuts(start: int, end: int) -> list[int]:
    """Ends of sequences whose lengths are the powers of two that sum up to the stretch."""
    out = []
    while start < end:
        start += 1 << ((end - start).bit_length() - 1)
        out.append(start)
    return out


def _packer(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = _codec(path).ends
        next_id = TaskContext.get().partitionId() << 40
        # Documents not yet placed: id (and whether it is null), tokens placed before, all tokens, tokens left.
        names, nulls = np.zeros(0, np.int64), np.zeros(0, bool)
        placed = totals = sizes = np.zeros(0, np.int64)
        ids = np.zeros(0, np.uint32)

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal names, nulls, placed, totals, sizes, ids, next_id
            doc_ends = np.cumsum(sizes)
            places, penalties = _places(ids, doc_ends, ends, capacity)
            cuts = places[cut(places, penalties, capacity, free_end=True)]
            if last:
                cuts = np.array([*cuts[:-1], *_binary_cuts(int(cuts[-2]), int(cuts[-1]))])
            else:
                cuts = cuts[:-1]
            whole = int(cuts[-1])
            starts = np.union1d(doc_ends - sizes, cuts)
            starts = starts[starts < whole]
            stops = np.append(starts[1:], whole)
            doc = np.searchsorted(doc_ends, starts, side="right")
            sequence = np.searchsorted(cuts, starts, side="right") - 1
            raw = ids.astype("<u4", copy=False).tobytes()
            columns = [
                pa.array(names[doc], mask=nulls[doc]),
                pa.array(placed[doc] + starts - (doc_ends - sizes)[doc]),
                pa.array(stops - starts),
                pa.array([raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), stops.tolist())], pa.binary()),
                pa.array(totals[doc]),
                pa.array(next_id + sequence),
                pa.array(starts - cuts[sequence]),
            ]
            next_id += len(cuts) - 1
            left = doc_ends > whole
            done = np.maximum(0, whole - (doc_ends - sizes))[left]
            names, nulls, totals = names[left], nulls[left], totals[left]
            placed, sizes, ids = placed[left] + done, sizes[left] - done, ids[whole:]
            return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        for batch in sized_slices(batches, 1, size=SLICE):
            own, counts = encode(path, batch.column(1))
            names = np.concatenate([names, batch.column(0).fill_null(0).to_numpy()])
            nulls = np.concatenate([nulls, batch.column(0).is_null().to_numpy(zero_copy_only=False)])
            placed = np.concatenate([placed, np.zeros(len(counts), np.int64)])
            totals, sizes = np.concatenate([totals, counts]), np.concatenate([sizes, counts])
            ids = np.concatenate([ids, own])
            if len(ids) >= STRETCH:
                yield flush(last=False)
        if len(ids):
            yield flush(last=True)

    return run


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` tokens.

    Needs doc_id and text; other columns are ignored. A null or empty text is one end id. Repeated rows are packed
    as often as they occur, an empty table gives no rows, and null ids stay null.
    ``ids`` holds a piece's tokens as little-endian unsigned 32-bit numbers, ``start`` its place in the document and
    ``offset`` its place in the sequence.
    """
    needed = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return needed.mapInArrow(_packer(tokenizer, capacity), PIECES)


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed, with the checksum of each piece's ids."""
    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the pieces of the packed documents, with their ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
