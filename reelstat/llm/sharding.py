"""Put records into shards through fixed virtual slots.

A record's text hashes to one of a fixed number of slots, so equal texts meet in one slot. Bytes are summed per slot,
and a versioned map sends slots to shards. To rebalance, the map is edited: a slot stays where it is as long as
its shard has room. A text that alone outweighs a shard's fair share, because it is copied very often, is cut into
parts by the hash of the record's id, which are mapped one by one; all other equal texts stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from reelstat.llm.common import stored, table

SLOTS = 4096
# Parts of a slot. They bound the rows that are numbered together; the size table has SLOTS * PARTS rows at most.
PARTS = 256
SHARDS = 8
# What a shard may hold beyond its fair share before an edit of the map takes slots from it.
TOLERANCE = 0.001


def heavy_texts(records: DataFrame, shards: int = SHARDS) -> list[int]:
    """The hashes of texts of which all rows together hold more bytes than a shard's fair share; fewer than ``shards``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long").alias("size")
    sizes = records.select(F.xxhash64(text).alias("text_hash"), size).groupBy("text_hash").agg(F.sum("size").alias("bytes"))
    total = sizes.agg(F.sum("bytes").alias("total"))
    heavy = sizes.join(F.broadcast(total), F.col("bytes") > F.col("total") / shards)
    return sorted(r["text_hash"] for r in heavy.select("text_hash").collect())


def slotted(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, slot, part and whether the text is a heavy one, of every record.

    A null text counts as empty. Equal texts have one slot; only a text that alone outweighs a shard may be parted.
    """
    heavy = heavy_texts(records, shards)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    return records.select(
        doc.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(SLOTS)).cast("int").alias("virtual_slot"),
        (F.xxhash64(text).isin(heavy) if heavy else F.lit(False)).alias("heavy"),
        F.pmod(F.xxhash64(doc, F.lit("part")), F.lit(PARTS)).cast("int").alias("part"),
    )


def slot_sizes(records: DataFrame) -> DataFrame:
    """Bytes and rows of each part of each slot, those of heavy texts apart; combined before the shuffle."""
    return records.groupBy("virtual_slot", "heavy", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))


def _units(sizes: DataFrame) -> DataFrame:
    """What the map sends as one: a slot (-1), or a part of the heavy texts in it."""
    unit = F.when(F.col("heavy"), F.col("part")).otherwise(F.lit(-1))
    return sizes.groupBy("virtual_slot", unit.alias("unit")).agg(F.sum("bytes").alias("bytes"))


def slot_map(sizes: DataFrame, shards: int = SHARDS, old: DataFrame | None = None, version: int = 1) -> DataFrame:
    """A map (version, virtual_slot, unit, shard) in which all shards hold nearly the same bytes.

    Units go to shards from the largest down: to the shard of the ``old`` map if it has room, else to the lightest.
    The fold runs over the units, of which there are SLOTS plus PARTS for each of fewer than ``shards`` heavy texts.
    """
    units = _units(sizes)
    if old is None:
        units = units.withColumn("held", F.lit(-1))
    else:
        held = old.select("virtual_slot", "unit", F.col("shard").alias("held"))
        units = units.join(held, ["virtual_slot", "unit"], "left").fillna(-1, ["held"])
    listed = units.agg(
        F.sort_array(
            F.collect_list(F.struct("bytes", "virtual_slot", "unit", "held")), asc=False
        ).alias("units"),
        F.sum("bytes").alias("total"),
    )
    limit = F.col("total") / shards * (1 + TOLERANCE)

    def place(state: Column, unit: Column) -> Column:
        loads = state["loads"]
        lightest = (F.array_position(loads, F.array_min(loads)) - 1).cast("int")
        stays = (unit["held"] >= 0) & (unit["held"] < shards) & (
            F.coalesce(F.get(loads, unit["held"]), F.lit(0)) + unit["bytes"] <= limit
        )
        pick = F.when(stays, unit["held"]).otherwise(lightest)
        return F.struct(
            F.transform(loads, lambda x, i: F.when(i == pick, x + unit["bytes"]).otherwise(x)).alias("loads"),
            F.concat(state["shards"], F.array(pick)).alias("shards"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.array().cast("array<int>").alias("shards")
    )
    placed = listed.select("units", F.aggregate("units", start, place)["shards"].alias("shards"))
    pairs = placed.select(F.explode(F.arrays_zip("units", "shards")).alias("pair"))
    return pairs.select(
        F.lit(version).alias("version"), "pair.units.virtual_slot", "pair.units.unit", F.col("pair.shards").alias("shard")
    )


def shard(records: DataFrame, sizes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Every slotted record with its shard and its gapless place in it, from 0.

    Places within a part of a slot follow doc_id; parts of a shard stand end to end. The join and the numbering
    use the same partitioning by slot and part, so records are shuffled once.
    """
    unit = F.when(F.col("heavy"), F.col("part")).otherwise(F.lit(-1))
    mapped = sizes.withColumn("unit", unit).join(mapping.select("virtual_slot", "unit", "shard"), ["virtual_slot", "unit"])
    version = mapping.agg(F.max("version").alias("map_version"))
    order = ["virtual_slot", "heavy", "part"]
    before = Window.partitionBy("shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = mapped.select(*order, "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy(*order).orderBy("doc_id", "text_crc32", "size")
    return (
        records.withColumn("place", F.row_number().over(within) - 1)
        .join(offsets, order)
        .crossJoin(F.broadcast(version))
        .withColumn("slot", F.col("before") + F.col("place"))
    )


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 7 of nearly equal bytes.

    Null texts are empty, repeated rows get places of their own, an empty table gives no rows.
    """
    records = slotted(table(spark, folder, "documents"))
    sizes = stored(slot_sizes(records), "slot-sizes")
    mapping = stored(slot_map(sizes), "slot-map")
    return shard(records, sizes, mapping).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )
