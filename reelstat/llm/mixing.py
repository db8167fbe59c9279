"""Mix sources to target weights by weighted sampling without replacement.

Every document gets the exponential key ``-ln(u) / weight`` of its quality weight, with ``u`` drawn from a hash of its id.
A source takes as many whole epochs of its documents as its target holds, and then documents in the order of
their keys until the rest of the target is used up; the last of these is taken in part.

Where that point lies is found from sums per source and key bucket. Only the documents of the one bucket that holds
it are sorted, so no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from reelstat.llm.common import WORD, free_name, scratch, stored, table

# Key buckets of a source.
BUCKETS = 4096
# Epochs a source may be taken.
CAP = 3
SEED = "mix"
SYMBOLS = "#*$%&|<>"
# The weight of a text of nothing but symbols; one without symbols weighs 1.
LEAST_WEIGHT = 0.25


def quality_weight(text: Column) -> Column:
    """From LEAST_WEIGHT to 1, falling with the share of symbol characters."""
    kept = F.length(F.translate(text, SYMBOLS, ""))
    share = F.coalesce(F.try_divide(kept, F.length(text)), F.lit(1.0))
    return LEAST_WEIGHT + (1 - LEAST_WEIGHT) * share


def key_columns(seed: str = SEED) -> dict[str, Column]:
    """doc_id, source, size in words, sampling key and key bucket of a document."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    number = F.conv(F.substring(F.md5(F.concat(doc, F.lit(f":{seed}")).cast("binary")), 1, 13), 16, 10)
    uniform = (number.cast("double") + 0.5) / float(1 << 52)
    text = F.col("text").cast("string")
    key = -F.log(uniform) / quality_weight(text)
    return {
        "doc_id": F.col("doc_id").cast("long"),
        "source": F.col("source").cast("string"),
        "size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
        "key": key,
        "bucket": F.least(F.floor((1 - F.exp(-key)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"),
    }


def keyed(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """The :func:`key_columns` of every document."""
    return documents.select(*[c.alias(name) for name, c in key_columns(seed).items()])


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets of (source, source_size) rows: shares by weight of all sizes, at most CAP times a source's size.

    Sources in code-point order, null last, weigh 1, 2, 3 and so on in turn. In the order of cap by weight the sources
    that stay at their cap come first, so one pass finds them; there is one row per source.
    """
    weight = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1
    capped = sizes.withColumn("weight", weight).withColumn("cap", CAP * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole)
    left = total - F.coalesce(F.sum("cap").over(ahead), F.lit(0))
    weights = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))
    at_cap = F.col("cap") / F.col("weight") <= left / weights
    marked = capped.withColumn("at_cap", at_cap)
    spent = F.sum(F.when(F.col("at_cap"), F.col("cap")).otherwise(0)).over(whole)
    used = F.sum(F.when(F.col("at_cap"), F.col("weight")).otherwise(0)).over(whole)
    level = (F.sum("source_size").over(whole) - spent) / (F.sum("weight").over(whole) - used)
    target = F.when(F.col("at_cap"), F.col("cap").cast("double")).otherwise(F.col("weight") * level)
    return marked.select("source", "source_size", target.alias("target"))


def planned(docs: DataFrame) -> DataFrame:
    """One row per source of the keyed rows: how many whole epochs it takes, and where the rest of its target ends.

    The rest ends in ``last_bucket``, of which the buckets ahead hold ``ahead`` words; null if no bucket goes beyond it.
    """
    buckets = docs.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")))
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    targets = targets.withColumn("epochs", epochs).withColumn(
        "rest", F.floor("target") - F.col("epochs") * F.col("source_size")
    )
    upto = Window.partitionBy("source").orderBy("bucket")
    summed = buckets.withColumn("upto", F.sum("words").over(upto))
    same = summed.source.eqNullSafe(targets.source)
    # The bucket that holds the end of the rest is the first whose running sum goes beyond it.
    point = (
        summed.join(targets, same)
        .filter(F.col("upto") > F.col("rest"))
        .groupBy(summed.source.alias("point_source"))
        .agg(
            F.min("bucket").alias("last_bucket"),
            F.min_by(F.col("upto") - F.col("words"), "bucket").alias("ahead"),
        )
    )
    return targets.join(point, targets.source.eqNullSafe(F.col("point_source")), "left").select(
        targets.source.alias("plan_source"), "source_size", "target", "epochs", "rest", "last_bucket", "ahead"
    )


def _extra_at_border(source: str, rest: str, ahead: str, size: str, *order: str) -> Column:
    """The words that a row of a source's last bucket adds, of rows in the given order."""
    before = Window.partitionBy(source).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    room = F.col(rest) - F.col(ahead) - F.coalesce(F.sum(size).over(before), F.lit(0))
    return F.greatest(F.lit(0), F.least(F.col(size), room))


def mix(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target and taken words.

    Needs doc_id, text and source; other columns are ignored. A null text has no words, a null source is a source.
    Documents with equal keys follow doc_id, then size; repeated rows count each. Empty sources get nothing.
    The result is a function of the rows alone.
    """
    docs = stored(keyed(documents, seed), "mix-keys")
    plan = stored(planned(docs), "mix-plan")
    rows = docs.join(plan, docs.source.eqNullSafe(plan.plan_source)).drop("plan_source")
    at_border = rows.filter("bucket = last_bucket")
    extra = _extra_at_border("source", "rest", "ahead", "size", "key", "doc_id", "size")
    sure = F.when(F.col("bucket") < F.col("last_bucket"), F.col("size")).otherwise(F.lit(0))
    both = at_border.withColumn("extra", extra).unionByName(
        rows.filter("last_bucket is null or bucket <> last_bucket").withColumn("extra", sure)
    )
    return both.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
    )


def _repeated(rows: DataFrame, columns: list[str], size: Column, epochs: Column, extra: Column, name: str) -> DataFrame:
    """Each row as often as it is taken whole, and once more with its first words if a part of it is taken."""
    whole = (epochs + F.when(extra == size, 1).otherwise(0)).cast("int")
    part = F.when(extra == size, 0).otherwise(extra).cast("int")
    times = whole + F.when(part > 0, 1).otherwise(0)
    # An empty list gives no row.
    listed = F.when((size > 0) & (times > 0), F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))
    again = rows.withColumn(name, F.explode(listed))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), F.lit(1), part), " ")
    text = F.when(F.col(name) > whole, cut).otherwise(F.col("text"))
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return again.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in columns])


def mixed_documents(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows of the mix, with all their columns: a document stands in it as often as its source's epochs take it.

    The document at the end of a source's budget adds the words the budget still has room for. Texts are not shuffled:
    a row's key tells in the scan what it adds, except in the one bucket of a source where its budget ends. Only the rows
    of these are written apart and put in order. Rows alike in key, id and size follow the hash of their text.
    """
    name = free_name(documents.columns, "mix")
    keys = keyed(documents, seed)
    with scratch(documents.sparkSession):
        plan = stored(planned(stored(keys, "mix-keys")), "mix-plan", outlives=True)
    mine = plan.select([F.col(c).alias(f"{name}_{c}") for c in plan.columns])
    of = lambda c: F.col(f"{name}_{c}")
    # The columns of ``keyed`` beside the row's own.
    own = documents.select(
        *[F.col(f"`{c}`") for c in documents.columns],
        *[c.alias(f"{name}_{k}") for k, c in key_columns(seed).items()],
    )
    rows = own.join(mine, of("source").eqNullSafe(of("plan_source")))
    border = F.coalesce(of("bucket") == of("last_bucket"), F.lit(False))
    extra = F.when(of("bucket") < of("last_bucket"), of("size")).otherwise(F.lit(0))
    inside = _repeated(rows.filter(~border), documents.columns, of("size"), of("epochs"), extra, f"{name}_time")
    # Few rows: one bucket of each source.
    apart = stored(
        rows.filter(border)
        .withColumn(f"{name}_row", F.monotonically_increasing_id())
        .withColumn(f"{name}_hash", F.md5(F.col("text").cast("binary"))),
        "mix-border",
    )
    order = [f"{name}_{c}" for c in ("key", "doc_id", "size", "hash", "row")]
    part = _extra_at_border(f"{name}_source", f"{name}_rest", f"{name}_ahead", f"{name}_size", *order)
    added = apart.select(*[F.col(c) for c in apart.columns if c.startswith(f"{name}_")]).select(
        of("row").alias(f"{name}_of"), part.alias(f"{name}_extra")
    )
    placed = apart.join(added, of("row") == of("of"))
    last = _repeated(placed, documents.columns, of("size"), of("epochs"), of("extra"), f"{name}_time")
    return inside.unionByName(last)


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the mix itself."""
    return mixed_documents(docs)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / (0.25 + 0.75 * coalesce(CASE WHEN length(text) > 0 THEN length(translate(text, '#*$%&|<>', '')) / length(text) END, 1.0)) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS weight
  FROM d GROUP BY source),
m AS (
  SELECT *, cap / weight <= (sum(source_size) OVER () - coalesce(sum(cap) OVER ahead, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0)) AS at_cap
  FROM s WINDOW ahead AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, CASE WHEN at_cap THEN cap::DOUBLE ELSE weight * (
      (sum(source_size) OVER () - sum(CASE WHEN at_cap THEN cap ELSE 0 END) OVER ())
      / (sum(weight) OVER () - sum(CASE WHEN at_cap THEN weight ELSE 0 END) OVER ())) END AS target
  FROM m),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs, floor(p.target)::BIGINT - p.epochs * p.source_size
      - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken
FROM r
"""
