"""Near-duplicate documents: banded min-hashing, sequential Bayesian verification, exact confirmation.

1. Every text becomes a set of hashed five-word shingles, a min-hash signature and a key of the whole set. Documents of
   equal sets collapse to the smallest id; only these representatives go on.
2. Bands of the signature name buckets. Buckets grow with the most copied text, so pairs within them are never listed.
   Each member is first compared with the smallest member of its buckets, and what is confirmed is tied together.
3. Only buckets that still hold several components are looked at again. Their members meet in blocks, all pairs of
   different components are compared in memory, batch of the signature by batch: a pair is dropped as soon as
   the posterior probability that its similarity reaches the threshold falls below ``MISS``.
4. Survivors of either step are confirmed on the full sets of their texts.

A link at the threshold is missed with probability (1 - 0.75**ROWS)**BANDS, about 2e-5, and by pruning with MISS; links of
more similar texts are missed far more rarely.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelstat.llm.common import (
    free_name,
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
from reelstat.llm.graphs import components

SHINGLE = 5
BANDS, ROWS = 40, 5
# Values of a signature; the first BANDS * ROWS make the bands, all are used to verify.
HASHES = 400
BATCH = 40
# Similarity threshold as a fraction: 100 * intersection >= 75 * union.
PART, WHOLE = 75, 100
# Posterior probability of a link below which a pair is dropped.
MISS = 1e-5
# Members of a bucket that meet in one block.
BLOCK = 2048
# Bytes of text whose shingles are looked at together.
SLICE = 1 << 18

# Of each value of a signature the lower 16 bits are kept to verify; bands are named by all bits.
SIGNED = "doc_id long, text_hash long, n_shingles long, set_key binary, signature binary, bands binary"
_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_key", pa.binary()),
        ("signature", pa.binary()),
        ("bands", pa.binary()),
    ]
)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end, and where each text's begin.

    Words are ASCII-lower-cased runs without ASCII white space; a text with fewer than five words is one shingle.
    """
    data, starts = text_bytes(column)
    data = lower_ascii(data)
    first, last, rows = word_spans(data, starts)
    n_rows = len(starts) - 1
    words = span_hashes(prefix_hashes(data), first, last)
    count = np.bincount(rows, minlength=n_rows)
    begin = np.concatenate([[0], np.cumsum(count)])
    # Shingle k of a text ends at its word k + SHINGLE - 1, or at its last word if it is shorter.
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(n_rows + 1, np.int64)
    h = np.zeros(len(words), np.uint64)
    place = np.arange(len(words)) - begin[rows]
    for k in range(SHINGLE):
        at = np.arange(len(words)) + k
        inside = place + k < count[rows]
        h = np.where(inside, mix(h * np.uint64(0x9E3779B97F4A7C15) + words[np.minimum(at, len(words) - 1)]), h)
    keep = (place + SHINGLE <= count[rows]) | (place == 0)
    h, rows = h[keep], rows[keep]
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    h, rows = h[new], rows[new]
    return h, np.searchsorted(rows, np.arange(n_rows + 1))


@functools.cache
def _seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return (
        rng.integers(1, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1),
        rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32),
    )


def signature(h: np.ndarray) -> np.ndarray:
    """Minimum of each of HASHES functions over a set of hashes, which must not be empty."""
    multiply, add = _seeds()
    low, high = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(h), 512):
        x = multiply[:, None] * low[None, start : start + 512]
        x ^= x >> np.uint32(15)
        x += add[:, None] ^ high[None, start : start + 512]
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def _bands(signatures: np.ndarray) -> np.ndarray:
    """Bucket names (rows, BANDS) of signatures."""
    values = signatures[:, : BANDS * ROWS].reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), values.shape[:2]) + np.uint64(1)
    for k in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + values[:, :, k])
    return h.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sized_slices(batches, 2, size=SLICE):
        h, starts = shingle_sets(batch.column(2))
        keys: list[bytes | None] = []
        values = np.zeros((batch.num_rows, HASHES), np.uint32)
        for row, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
            own = h[a:b]
            if a == b:
                keys.append(None)
                continue
            keys.append(np.array([own.sum(), mix(own * np.uint64(3)).sum(), b - a], np.uint64).tobytes())
            values[row] = signature(own)
        known = [k is not None for k in keys]
        low, bands = values.astype(np.uint16), _bands(values)
        columns = [
            batch.column(0),
            batch.column(1),
            pa.array(np.diff(starts)),
            pa.array(keys, pa.binary()),
            pa.array([v.tobytes() if k else None for v, k in zip(low, known)], pa.binary()),
            pa.array([v.tobytes() if k else None for v, k in zip(bands, known)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_SIGNED)


@functools.cache
def least_matches() -> tuple[int, ...]:
    """For each batch of the signature: matches so far below which a pair is dropped.

    With a uniform prior the similarity after m of n matches follows Beta(m + 1, n - m + 1).
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = 0
        while True:
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            density = np.exp(log - log.max())
            if density[grid >= PART / WHOLE].sum() / density.sum() >= MISS:
                break
            m += 1
        out.append(m)
    return tuple(out)


def _matrix(values: list[bytes], type_: type) -> np.ndarray:
    return np.frombuffer(b"".join(values), type_).reshape(len(values), -1)


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            buckets = _matrix(batch.column(1).to_pylist(), np.int64)
            node = np.repeat(batch.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(buckets.ravel()), pa.array(node)], names=["bucket", "node"])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the pairs (a, b, signature of a, signature of b) those that no batch of the signatures rules out."""
    least = least_matches()
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        one, two = (_matrix(batch.column(c).to_pylist(), np.uint16) for c in (2, 3))
        alive, matches = np.arange(n), np.zeros(n, np.int64)
        for k, m in enumerate(least):
            part = slice(k * BATCH, (k + 1) * BATCH)
            matches = matches + (one[alive, part] == two[alive, part]).sum(axis=1)
            stay = matches >= m
            alive, matches = alive[stay], matches[stay]
        yield batch.select([0, 1]).take(pa.array(alive))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the pairs (a, b, text of a, text of b) those whose full sets reach the threshold."""
    for batch in sized_slices(batches, 2, rows=1024, size=SLICE):
        one, first = shingle_sets(batch.column(2))
        two, second = shingle_sets(batch.column(3))
        good = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            a, b = one[first[k] : first[k + 1]], two[second[k] : second[k + 1]]
            at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
            common = int((b[at] == a).sum()) if len(b) else 0
            good[k] = WHOLE * common >= PART * (len(a) + len(b) - common)
        yield batch.select([0, 1]).filter(pa.array(good))


def _block_pairs(table_: pa.Table) -> pa.Table:
    """Pairs of one block of a bucket that differ in component and that the signatures do not rule out.

    A pair that shares several buckets is left to that of the first band.
    """
    least = least_matches()
    low, high = table_.column("low")[0].as_py(), table_.column("high")[0].as_py()
    chunk = table_.column("chunk").to_numpy()
    doc, root = table_.column("node").to_numpy(), table_.column("root").to_numpy()
    size = table_.column("n_shingles").to_numpy()
    signs = _matrix(table_.column("signature").to_pylist(), np.uint16)
    buckets = _matrix(table_.column("bands").to_pylist(), np.int64)
    before = buckets[:, : int(np.flatnonzero(buckets[0] == table_.column("bucket")[0].as_py())[0])]
    rows, others = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    left, right = [], []
    for i in rows:
        j = others[root[others] != root[i]]
        j = j[doc[j] > doc[i]] if low == high else j
        j = j[WHOLE * np.minimum(size[j], size[i]) >= PART * np.maximum(size[j], size[i])]
        matches = np.zeros(len(j), np.int64)
        for k, m in enumerate(least):
            part = slice(k * BATCH, (k + 1) * BATCH)
            matches = matches + (signs[j, part] == signs[i, part]).sum(axis=1)
            j, matches = j[matches >= m], matches[matches >= m]
            if not len(j):
                break
        j = j[~(before[j] == before[i]).any(axis=1)]
        left.append(np.full(len(j), doc[i]))
        right.append(doc[j])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) confirmed on the full sets of their texts."""
    one, two = texts.toDF("a", "one"), texts.toDF("b", "two")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return both.mapInArrow(_confirm, "a long, b long")


def _shared_ids(sets: DataFrame, several: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the nodes of the different sets of one id."""
    node = classes.select("set_key", "node")
    own = sets.select("doc_id", "set_key").join(several, "doc_id").select("set_key", "s0").distinct()
    ends = own.join(node.withColumnRenamed("node", "a"), "set_key")
    return ends.join(node.toDF("s0", "b"), "s0").filter("a <> b").select("a", "b")


def _linked(needed: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of the rows (doc_id, text_hash, text)."""
    signed = stored(needed.mapInArrow(_sign, SIGNED), "signatures")
    sets = signed.filter("set_key is not null and doc_id is not null")
    # Ids that stand for several sets, with one of these; where ids are unique there are none.
    several = sets.groupBy("doc_id").agg(F.min("set_key").alias("s0"), F.max("set_key").alias("s1"))
    several = stored(several.filter("s0 <> s1").select("doc_id", "s0"), "several-sets")
    # One representative text for all documents of the same set. Its id names the set, or a hash if it has several sets.
    first = F.min(F.struct("doc_id", "text_hash")).alias("rep")
    reps = sets.groupBy("set_key").agg(first, F.min("n_shingles").alias("n_shingles"))
    reps = reps.select("set_key", "rep.doc_id", "rep.text_hash").join(several, "doc_id", "left")
    node = F.when(F.col("s0").isNull(), F.col("doc_id")).otherwise(F.xxhash64("set_key")).alias("node")
    classes = stored(reps.select("set_key", "doc_id", "text_hash", node), "classes")
    rep_signed = stored(
        sets.join(classes, ["set_key", "doc_id", "text_hash"])
        .dropDuplicates(["node"])
        .select("node", "n_shingles", "signature", "bands"),
        "representatives",
    )
    # Buckets with more than one representative, each with its smallest member.
    banded = stored(rep_signed.select("node", "bands").mapInArrow(_band_rows, "bucket long, node long"), "bands")
    shared = banded.groupBy("bucket").agg(F.min("node").alias("center"), F.max("node").alias("top"))
    members = stored(banded.join(shared.filter("center < top").drop("top"), "bucket"), "buckets")
    stars = members.filter("center <> node").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    signs = rep_signed.select("node", "n_shingles", "signature")
    one = signs.toDF("a", "size_a", "sign_a")
    two = signs.toDF("b", "size_b", "sign_b")
    sized = F.lit(WHOLE) * F.least("size_a", "size_b") >= F.lit(PART) * F.greatest("size_a", "size_b")
    likely = (
        stars.join(one, "a").join(two, "b").filter(sized)
        .select("a", "b", "sign_a", "sign_b")
        .mapInArrow(_likely, "a long, b long")
    )
    involved = classes.join(members.select("node").distinct(), "node").select("doc_id", "text_hash", "node")
    texts = stored(
        needed.join(involved, ["doc_id", "text_hash"]).dropDuplicates(["node"]).select("node", "text"), "texts"
    )
    links = stored(_verified(likely, texts).unionAll(_shared_ids(sets, several, classes)), "star-links")
    roots = stored(components(links), "star-roots")
    # Buckets that still hold several components: pairs of different components, compared in blocks.
    labelled = members.join(roots.withColumnRenamed("node", "of"), members.node == F.col("of"), "left").select(
        "bucket", members.node, F.coalesce("root", members.node).alias("root")
    )
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n"))
        .filter("r0 < r1")
        .select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks"))
    )
    chunked = (
        labelled.join(mixed, "bucket")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .join(rep_signed, "node")
        .select(
            "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
            "chunk", "node", "root", "n_shingles", "signature", "bands",
        )
    )
    rest = chunked.groupBy("bucket", "low", "high").applyInArrow(_block_pairs, "a long, b long")
    more = stored(_verified(rest, texts), "block-links")
    found = components(links.unionAll(more)).withColumnRenamed("node", "of")
    rooted = classes.join(found, classes.node == found.of, "left").select(
        "set_key", "doc_id", F.coalesce("root", classes.node).alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component"))
    named = rooted.join(smallest, "root").select("set_key", "component")
    # Rows without a set are linked with nothing.
    result = signed.join(named, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Needs doc_id and text; other columns are ignored. Texts without words have no set, are linked with nothing and
    are kept. Rows that share an id are one document for the links, whatever their texts; rows with a null id take no part,
    have a null component, and are kept. An empty table gives no rows.
    """
    text = F.col("text").cast("string")
    needed = documents.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    with scratch(documents.sparkSession):
        found = stored(_linked(needed), "near-duplicates", outlives=True)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_duplicates(table(spark, folder, "documents"))


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: one row of each group stays, that of the smallest id.

    Of rows that share this id, and of rows with a null id and the same text, the one with the least text hash stays.
    """
    name = free_name(docs.columns, "near")
    found = near_duplicates(docs)
    per_id = found.filter("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    # Only ids that go or repeat.
    fate = per_id.filter("not kept or n > 1").select(
        F.col("doc_id").alias(f"{name}_id"), F.when(F.col("kept"), "again").otherwise("gone").alias(f"{name}_fate")
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.col("doc_id").cast("long")
    fated = docs.withColumn(f"{name}_key", key).join(fate, F.col(f"{name}_key") == F.col(f"{name}_id"), "left")
    fate_of = F.when(F.col(f"{name}_key").isNull(), "again").otherwise(F.coalesce(F.col(f"{name}_fate"), F.lit("stays")))
    fated = fated.withColumn(f"{name}_fate", fate_of)
    stay = fated.filter(F.col(f"{name}_fate") == "stays").select(*columns)
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    group = F.when(F.col(f"{name}_key").isNull(), text)
    again = fated.filter(F.col(f"{name}_fate") == "again").groupBy(F.col(f"{name}_key"), group.alias(f"{name}_text"))
    one = again.agg(F.min_by(F.struct(*columns), text).alias(f"{name}_row")).select(f"{name}_row.*")
    return stay.unionAll(one)


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5
    THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 75 * (p.size + q.size - common)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS found FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.found),
k AS (SELECT node, min(found) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.size, 0)::BIGINT AS n_shingles, k.component_id, d.doc_id = k.component_id AS kept
FROM documents d JOIN k ON k.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
