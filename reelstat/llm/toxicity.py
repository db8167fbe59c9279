"""Toxicity by class-conditional Kneser-Ney models.

A toxic and an ordinary model are counted over all labelled rows that may be learned from. As in Kneser-Ney smoothing a
word counts by the number of different words before it, so that passages copied many times do not count as evidence. A
discount is taken off every count and given to shared backoff counts, which cover all documents of the corpus: words
that neither class holds beyond the discount are no evidence.

Different (word, word before) pairs are counted by shuffles combined on the map side, into tables with a row for each
word, which grow with the vocabulary. Words are told apart by 64-bit hashes, the words before one of them by 32 bits.
The labelled texts are shuffled to their labels once and kept, and their pairs are counted once: the words of the classes
and the pairs beyond the discount both follow from that count. The classes are counted first: only words that could tell
them apart, whatever their backoff is, are then counted over all documents. How many pairs all words have together is
estimated by a mergeable sketch (HyperLogLog).

Both models are of order two. A word after the word before it counts by the texts of the class that hold this pair. Here the
discount grows with the class, so that it takes the same share of both, and what it takes goes to a backoff that the classes
share, the pair's counts over both. A pair that either class holds beyond its discount is judged by order two; any other backs
off to its word, weighted by what the discounts leave the backoff after the word before.

A text's score compares the two length-normalised log-likelihoods. Words, pairs and backoff weights for which the models differ by less than
``MARGIN``, either way, say nothing, since a long text has very many of them. A logistic curve, fitted on as many learning
rows of each class and corrected for the real shares of the classes, turns the comparison into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelstat.llm.common import (
    file_by_file,
    lower_ascii,
    mix,
    prefix_hashes,
    scratch,
    sized_slices,
    span_hashes,
    stored,
    table,
    text_bytes,
    word_spans,
)

DISCOUNT = 2.0
# Of the smaller class, for texts that hold a pair. There are far more pairs than words, so that more come together by chance.
PAIR_DISCOUNT = 8.0
MARGIN = 1.0
# Words added to a text's length, so that one word of a very short text does not decide alone.
SHORT = 20
# Learning rows that the logistic curve is fitted on, at most.
SAMPLE = 6000
FOLDS = 5
# Words with evidence that every worker may hold; beyond them the words of documents are joined with the table.
HELD = 1 << 20
# Parts that the rows of a word are dealt over in that join.
SALT = 32
# Bits for each key of a set that lets rows through to a join, and bits of such a set at most.
KEY_BITS, MOST_BITS = 16, 1 << 27
# Bytes of text whose words are looked at together.
SLICE = 1 << 20
# Relative deviation of the number of different pairs of all documents.
SPREAD = 0.01


def learns(doc_id: Column, folds: int) -> Column:
    """The remainder that deals a document to a fold: crc32 of its id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Hash of every word, hash of the word before it in its text, row of the word, rows.

    Words are runs of letters, digits and bytes beyond ASCII, A-Z in lower case.
    """
    data, starts = text_bytes(column)
    data = lower_ascii(data)
    inside = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    data = np.where(inside, data, np.uint8(32))
    first, last, rows = word_spans(data, starts)
    words = span_hashes(prefix_hashes(data), first, last)
    before = np.concatenate([[np.uint64(0)], words[:-1]]) if len(words) else words
    if len(words):
        before[np.concatenate([[True], rows[1:] != rows[:-1]])] = 0
    return words, before, rows, len(starts) - 1


class KeySet:
    """A set of 64-bit keys as bits of bounded size: it lets all of them through and few others, before a join."""

    def __init__(self, keys: DataFrame):
        (key,) = keys.columns
        wanted = KEY_BITS * keys.count()
        self.bits = min(MOST_BITS, 1 << max(15, wanted.bit_length()))
        slot = self.slot(F.col(key))
        chunks = keys.groupBy(F.shiftright(slot, 15).alias("chunk")).agg(
            F.bitmap_construct_agg(slot.bitwiseAND(F.lit((1 << 15) - 1))).alias("chunk_bits")
        )
        packed = np.zeros((self.bits >> 15, 1 << 12), np.uint8)
        for row in chunks.toLocalIterator():
            packed[row["chunk"]] = np.frombuffer(row["chunk_bits"], np.uint8)
        self.packed = packed.ravel()

    def slot(self, key: Column) -> Column:
        return key.bitwiseAND(F.lit(self.bits - 1))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.view(np.int64) & np.int64(self.bits - 1)
        return (self.packed[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _pairs(words: np.ndarray, before: np.ndarray, kind: np.ndarray | None = None) -> list[pa.Array]:
    """The different pairs of a word and the word before it; ``kind`` is the lowest bit of the second number."""
    low = _low(before) if kind is None else _low(before) | kind
    # Equal pairs lie together in the order of a hash of both.
    order = np.argsort(mix(words ^ mix(low.view(np.uint64))), kind="stable")
    words, low = words[order].view(np.int64), low[order]
    first = np.ones(len(words), bool)
    first[1:] = (words[1:] != words[:-1]) | (low[1:] != low[:-1])
    return [pa.array(words[first]), pa.array(low[first].astype(np.int32))]


PAIR = "word long, before int"
# Pairs with the number of texts that hold them.
HOLDERS = f"{PAIR}, n long"


def _second_keys(words: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of backoff weights, by the word before (as in a pair's second number), and of pairs, apart from those of words."""
    low = low.astype(np.int64).view(np.uint64)
    return mix(low ^ np.uint64(1 << 40)).view(np.int64), mix(mix(low ^ np.uint64(1 << 41)) ^ words).view(np.int64)


def _low(before: np.ndarray) -> np.ndarray:
    return (mix(before + np.uint64(1)) & np.uint64(0x7FFFFFFE)).astype(np.int64)


def _all_pairs(only: KeySet | None = None):
    """The different pairs of a batch of texts, of the words in ``only``."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches, 0, size=SLICE):
            words, before, _, _ = _tokens(batch.column(0))
            if only is not None:
                kept = only.holds(words)
                words, before = words[kept], before[kept]
            yield pa.RecordBatch.from_arrays(_pairs(words, before), names=["word", "before"])

    return pairs


def _class_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different pairs of texts of each class; the lowest bit of ``before`` is the class."""
    for batch in sized_slices(batches, 0, size=SLICE):
        words, before, rows, _ = _tokens(batch.column(0))
        toxic = batch.column(1).to_numpy().astype(np.int64)[rows]
        yield pa.RecordBatch.from_arrays(_pairs(words, before, toxic), names=["word", "before"])


def _holders(only: KeySet | None = None):
    """The pairs of texts of each class with the number of texts that hold them; with ``only`` words before, summed up."""

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches, 0, size=SLICE):
            words, before, rows, _ = _tokens(batch.column(0))
            low = _low(before)
            if only is not None:
                kept = only.holds(low)
                words, rows, low = words[kept], rows[kept], low[kept]
            low = low | batch.column(1).to_numpy().astype(np.int64)[rows]
            # By word, so that rows of a word stand together in the shuffle and compress; rows of a pair stay in the texts' order.
            order = np.lexsort((low, words))
            words, low, rows = words[order], low[order], rows[order]
            pair = np.ones(len(words), bool)
            pair[1:] = (words[1:] != words[:-1]) | (low[1:] != low[:-1])
            text = pair.copy()
            text[1:] |= rows[1:] != rows[:-1]
            first = np.flatnonzero(pair)
            n = np.add.reduceat(text.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
            words, low = words[first], low[first]
            if only is not None:
                low, place = np.unique(low, return_inverse=True)
                words, n = np.zeros(len(low), np.uint64), np.bincount(place, n, len(low)).astype(np.int64)
            columns = [pa.array(words.view(np.int64)), pa.array(low.astype(np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "before", "n"])

    return holders


def _let_through(keys: KeySet):
    """The rows (doc_id, text, key) whose key may be in the set, without it."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = keys.holds(batch.column(2).to_numpy())
            yield batch.select([0, 1]).filter(pa.array(kept))

    return through


@dataclass
class Classes:
    """Of each class the different words before all words, and how much of them the discount takes."""

    # (word, t, o): different words before a word in the toxic and in the ordinary class.
    words: DataFrame
    total: dict[int, float]
    rest: dict[int, float]

    def ratio(self, backoff: Column) -> Column:
        """Log of toxic over ordinary probability of a word whose share of all pairs is ``backoff``."""
        logs = [
            F.log(F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / self.total[k] + self.rest[k] / self.total[k] * backoff)
            for k, c in ((1, "t"), (0, "o"))
        ]
        return logs[0] - logs[1]


def class_counts(pairs: DataFrame) -> Classes | None:
    """The counts of (word, before) pairs whose lowest bit is the class, or of what :func:`held_pairs` has counted of them;
    none if a class has no pair.
    """
    if "t" in pairs.columns:
        alone = F.col("before").isNotNull()
        pairs = pairs.select("word", *[F.when(alone, _once(c)).otherwise(F.col(c)).alias(c) for c in ("t", "o")])
    else:
        toxic = F.col("before").bitwiseAND(F.lit(1))
        pairs = pairs.distinct().select("word", toxic.alias("t"), (1 - toxic).alias("o"))
    counted = pairs.groupBy("word").agg(F.sum("t").cast("long").alias("t"), F.sum("o").cast("long").alias("o"))
    words = stored(counted, "toxic-classes")
    least = lambda c: F.sum(F.least(F.col(c), F.lit(DISCOUNT)))
    r = words.agg(F.sum("t").alias("t"), F.sum("o").alias("o"), least("t").alias("rt"), least("o").alias("ro")).first()
    if not r["t"] or not r["o"]:
        return None
    return Classes(words, {1: float(r["t"]), 0: float(r["o"])}, {1: float(r["rt"]), 0: float(r["ro"])})


def telling_words(classes: Classes, everything: float) -> DataFrame:
    """(word, t, o) of the words beyond the discount that some backoff count would put beyond the margin.

    The ratio rises or falls all the way with the backoff, so its ends bound it. A word follows at least as many different
    words in all documents as in a class.
    """
    most = F.greatest("t", "o")
    ends = F.greatest(F.abs(classes.ratio(most / everything)), F.abs(classes.ratio(F.lit(1.0))))
    return classes.words.filter((most > DISCOUNT) & (ends > MARGIN))


def log_ratios(shared: DataFrame, classes: Classes, words: DataFrame, everything: float) -> DataFrame:
    """(word, ratio) of the given words, from the different words before each over all documents (word, n)."""
    return words.join(shared, "word").select("word", classes.ratio(F.col("n") / everything).alias("ratio"))


def _beyond(ratio: Column) -> Column:
    """What a log ratio says beyond the margin."""
    return F.signum(ratio) * F.greatest(F.abs(ratio) - MARGIN, F.lit(0.0))


def _by_class(holders: DataFrame, *keys: str) -> DataFrame:
    """The keys with the texts that hold them in the toxic (t) and in the ordinary class (o)."""
    toxic = F.col("before").bitwiseAND(F.lit(1))
    rows = holders.withColumn("t", F.col("n") * toxic).withColumn("o", F.col("n") * (1 - toxic))
    rows = rows.withColumn("before", F.col("before") - toxic)
    return rows.groupBy(*keys).agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _second_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_numpy().view(np.uint64)
        weights, pairs = _second_keys(words, batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(weights), pa.array(pairs), *batch.columns], names=["weight_key", "pair_key", *batch.schema.names])


def _over(learned: dict[int, int]) -> dict[int, Column]:
    """Of each class the texts that hold a pair beyond the discount; ``learned`` is the number of texts in each class."""
    discount = {k: PAIR_DISCOUNT * learned[k] / min(learned.values()) for k in (0, 1)}
    return {k: F.greatest(F.col(c) - discount[k], F.lit(0.0)) for k, c in ((1, "t"), (0, "o"))}


def held_pairs(taught: DataFrame, learned: dict[int, int]) -> DataFrame:
    """(word, before, t, o) of the texts to learn from, in one count of their pairs.

    A pair that a class holds beyond the discount has a row of its own, with the texts of each class that hold it. All other
    pairs of a word are one row without ``before``, with the number of them in each class, as nothing else of them is needed.
    """
    counted = _by_class(taught.mapInArrow(_holders(), HOLDERS), "word", "before")
    over = _over(learned)
    own = (over[1] > 0) | (over[0] > 0)
    rows = counted.select(
        "word",
        F.when(own, F.col("before")).alias("before"),
        *[F.when(own, F.col(c)).otherwise(_once(c)).alias(c) for c in ("t", "o")],
    )
    return rows.groupBy("word", "before").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _once(texts: str) -> Column:
    """1 for a pair that some texts hold."""
    return F.when(F.col(texts) > 0, 1).otherwise(0)


def order_two(taught: DataFrame, pairs: DataFrame, learned: dict[int, int], ratios: DataFrame) -> DataFrame | None:
    """(word, weight) of what pairs and backoff weights say beyond the margin and other than their words; none if none does.

    Needs text and toxic of the rows to learn from, their :func:`held_pairs`, their number in each class, and the words'
    (word, ratio).
    """
    over = _over(learned)
    held = pairs.filter("before is not null").select("word", "before", "t", "o", over[1].alias("t_over"), over[0].alias("o_over"))
    befores = held.groupBy("before").agg(F.sum("t_over").alias("t_taken"), F.sum("o_over").alias("o_taken"))
    befores = stored(befores, "toxic-befores")
    if befores.isEmpty():
        return None
    only = KeySet(befores.select(F.col("before").cast("long").alias("key")))
    every = _by_class(taught.mapInArrow(_holders(only), HOLDERS), "before").toDF("before", "t_all", "o_all")
    # What is left to the backoff after a word: all where a class does not hold the word.
    left = lambda c: F.when(F.col(f"{c}_all") > 0, 1 - F.col(f"{c}_taken") / F.col(f"{c}_all")).otherwise(1.0)
    after = befores.join(every, "before").withColumn("t_left", left("t")).withColumn("o_left", left("o"))
    shared = (F.col("t") + F.col("o")) / (F.col("t_all") + F.col("o_all"))
    logs = lambda c: F.log(F.col(f"{c}_over") / F.greatest(f"{c}_all", F.lit(1)) + F.col(f"{c}_left") * shared)
    pairs = held.join(after, "before").select(
        "word", "before", (logs("t") - logs("o")).alias("pair"), F.log(F.col("t_left") / F.col("o_left")).alias("left")
    )
    single = ratios.select("word", F.col("ratio").alias("single"))
    found = pairs.join(single, "word", "left").select(
        "word", "before", _beyond(F.col("left")).alias("left"),
        (_beyond(F.col("pair")) - _beyond(F.col("left")) - _beyond(F.coalesce("single", F.lit(0.0)))).alias("more"),
    )
    keyed = found.mapInArrow(
        _second_rows, "weight_key long, pair_key long, word long, before int, left double, more double"
    )
    keyed = stored(keyed.filter("left <> 0 or more <> 0"), "toxic-second")
    backoff = keyed.filter("left <> 0").groupBy(F.col("weight_key").alias("word")).agg(F.first("left").alias("weight"))
    return backoff.unionAll(keyed.filter("more <> 0").select("pair_key", "more"))


class Evidence:
    """What the words beyond the margin add to a text's score: held by every worker, or as a table if there are many.

    ``further`` holds the keys and weights of order two.
    """

    def __init__(self, ratios: DataFrame, further: DataFrame | None = None):
        beyond = ratios.filter(F.abs("ratio") > MARGIN).select("word", _beyond(F.col("ratio")).alias("weight"))
        self.second = None if further is None else KeySet(further.select("word"))
        beyond = beyond if further is None else beyond.unionAll(further)
        self.table = stored(beyond, "toxic-words", outlives=True)
        self.words = self.weights = None
        if self.table.count() <= HELD:
            found = self.table.orderBy("word").toArrow()
            self.words, self.weights = found.column("word").to_numpy(), found.column("weight").to_numpy()

    def compare(self, documents: DataFrame) -> DataFrame:
        """The other columns of every row and ``value`` for its ``text``."""
        kept = [c for c in documents.columns if c != "text"]
        fields = [f.simpleString().replace(":", " ", 1) for f in documents.select(*kept).schema]
        rows = documents.select("text", *kept)
        if self.words is not None:
            words, weights, second = self.words, self.weights, self.second

            def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in sized_slices(batches, 0, size=SLICE):
                    value = pa.array(comparison(words, weights, batch.column(0), second))
                    yield pa.RecordBatch.from_arrays([*batch.columns[1:], value], names=[*kept, "value"])

            return rows.mapInArrow(held, ", ".join([*fields, "value double"]))
        # Words of a text with their numbers, and a row without a word that keeps the text.
        listed = rows.withColumn("row", F.monotonically_increasing_id())
        second = self.second
        listed = listed.mapInArrow(
            lambda batches: _listed(batches, kept, second), ", ".join([*fields, "row long", "n_words long", "word long", "n long"])
        )
        listed = stored(listed, "toxic-listed").withColumn("salt", F.pmod("row", F.lit(SALT)))
        salted = self.table.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
        joined = listed.join(salted, ["word", "salt"]).groupBy("row").agg(F.sum(F.col("n") * F.col("weight")).alias("evidence"))
        texts = listed.filter("word is null").drop("word", "n", "salt").join(joined, "row", "left")
        return texts.select(*kept, (F.coalesce("evidence", F.lit(0.0)) / (F.col("n_words") + SHORT)).alias("value"))


def _with_second(words: np.ndarray, before: np.ndarray, rows: np.ndarray, second: KeySet | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of words with their rows, and those of backoff weights and pairs that may be in the set."""
    keys, of = [words.view(np.int64)], [rows]
    for more in _second_keys(words, _low(before)) if second is not None else ():
        kept = second.holds(more)
        keys.append(more[kept])
        of.append(rows[kept])
    return np.concatenate(keys), np.concatenate(of)


def _listed(batches: Iterator[pa.RecordBatch], kept: list[str], second: KeySet | None = None) -> Iterator[pa.RecordBatch]:
    for batch in sized_slices(batches, 0, size=SLICE):
        words, before, rows, n = _tokens(batch.column(0))
        n_words = np.bincount(rows, minlength=n)
        words, rows = _with_second(words, before, rows, second)
        order = np.lexsort((words, rows))
        words, rows = words[order], rows[order]
        first = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (rows[1:] != rows[:-1])])) if len(words) else []
        first = np.asarray(first, np.int64)
        at = np.concatenate([np.arange(n), rows[first]])
        word = pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(words[first])])
        times = np.concatenate([np.zeros(n, np.int64), np.diff(np.append(first, len(words)))])
        whole = batch.take(pa.array(at))
        columns = [*whole.columns[1:], pa.array(n_words[at]), word, pa.array(times)]
        yield pa.RecordBatch.from_arrays(columns, names=[*kept, "row", "n_words", "word", "n"])


def comparison(known: np.ndarray, weights: np.ndarray, column: pa.Array, second: KeySet | None = None) -> np.ndarray:
    """Per text: length-normalised sum of the weights of its words and pairs. The known keys are in order."""
    words, before, rows, n = _tokens(column)
    size = np.bincount(rows, minlength=n)
    words, rows = _with_second(words, before, rows, second)
    evidence = np.zeros(n)
    if len(known) and len(words):
        place = np.minimum(np.searchsorted(known, words), len(known) - 1)
        evidence = np.bincount(rows, np.where(known[place] == words, weights[place], 0.0), n)
    return evidence / (size + SHORT)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a logistic curve, by Newton steps with a little regularisation."""
    design = np.stack([np.ones_like(x), x], axis=1)
    beta = np.array([0.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 1e-3 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return float(beta[0]), float(max(beta[1], 0.0))


def fit(documents: DataFrame, labels: DataFrame) -> tuple[Evidence | None, tuple[float, float]]:
    """The words with evidence and the logistic curve, learned from (doc_id, toxic) rows outside the held-out fold.

    Labels that are null or neither 0 nor 1 teach nothing. Without a toxic and an ordinary row every score is 0.5.
    """
    with scratch(documents.sparkSession):
        return _fit(documents, labels)


def _fit(documents: DataFrame, labels: DataFrame) -> tuple[Evidence | None, tuple[float, float]]:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    ).filter(F.col("toxic").isin(0, 1) & (learns(F.col("doc_id"), FOLDS) != 0))
    # Of several labels of an id the least counts.
    known = stored(known.groupBy("doc_id").agg(F.min("toxic").alias("toxic")), "toxic-known")
    # Few texts without a label are shuffled. The join is the same at every size, as labels grow with the documents.
    key = F.xxhash64("doc_id")
    labelled = KeySet(known.select(key.alias("key")))
    likely = docs.filter(F.col("doc_id").isNotNull()).withColumn("key", key)
    taught = likely.mapInArrow(_let_through(labelled), "doc_id long, text string").join(known.hint("merge"), "doc_id")
    # Read several times, so the texts are shuffled to their labels once and kept.
    taught = stored(taught, "toxic-taught")
    ids = taught.select("doc_id", "toxic")
    learned = {r["toxic"]: r["count"] for r in ids.groupBy("toxic").count().collect()}
    if not learned.get(0) or not learned.get(1):
        return None, (0.0, 0.0)
    with file_by_file(documents.sparkSession):
        counted = stored(held_pairs(taught.select("text", "toxic"), learned), "toxic-pairs")
    classes = class_counts(counted)
    if classes is None:
        return None, (0.0, 0.0)
    pairs = docs.select("text").mapInArrow(_all_pairs(), PAIR)
    everything = float(pairs.agg(F.approx_count_distinct(F.struct("word", "before"), SPREAD)).first()[0])
    words = stored(telling_words(classes, everything), "toxic-telling")
    pairs = docs.select("text").mapInArrow(_all_pairs(KeySet(words.select("word"))), PAIR)
    shared = pairs.distinct().groupBy("word").agg(F.count("*").alias("n"))
    ratios = stored(log_ratios(shared, classes, words, everything), "toxic-ratios")
    evidence = Evidence(ratios, order_two(taught.select("text", "toxic"), counted, learned, ratios))
    return evidence, _fitted_curve(docs, ids, learned, evidence)


def _fitted_curve(
    docs: DataFrame, ids: DataFrame, learned: dict[int, int], evidence: Evidence
) -> tuple[float, float]:
    """The curve of as many rows of each class, of those (doc_id, toxic) that have a document."""
    order = F.xxhash64("doc_id", F.lit("sample"))
    sample = ids.limit(0)
    for k in range(2):
        some = ids.filter(F.col("toxic") == k).dropDuplicates(["doc_id"]).orderBy(order, "doc_id").limit(SAMPLE // 2)
        sample = sample.unionAll(some)
    sample = stored(sample, "toxic-sample")
    rows = evidence.compare(docs.join(F.broadcast(sample), "doc_id").select("text", "toxic")).select("value", "toxic")
    found = np.array([(r["value"], r["toxic"]) for r in rows.collect()]).reshape(-1, 2)
    middle, spread = found[:, 0].mean(), found[:, 0].std() or 1.0
    offset, slope = _curve((found[:, 0] - middle) / spread, found[:, 1])
    offset, slope = offset - slope * middle / spread, slope / spread
    # Each class weighs as many rows as were learned from, not as many as were drawn.
    toxic = found[:, 1].sum()
    offset += np.log(learned[1] / toxic) - np.log(learned[0] / (len(found) - toxic))
    return float(offset), float(slope)


def score(documents: DataFrame, evidence: Evidence | None, curve: tuple[float, float]) -> DataFrame:
    """doc_id and score of every row; null and empty texts get the score of no evidence."""
    offset, slope = curve
    needed = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if evidence is None:
        return needed.select("doc_id", F.lit(0.5).alias("score"))
    power = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(offset) + F.lit(slope) * F.col("value")))
    return evidence.compare(needed).select("doc_id", (1 / (1 + F.exp(-power))).alias("score"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document. Repeated rows are scored each; an empty table gives no rows."""
    documents = table(spark, folder, "documents")
    evidence, curve = fit(documents, table(spark, folder, "labels"))
    return score(documents, evidence, curve).select(
        "doc_id",
        F.coalesce(learns(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
