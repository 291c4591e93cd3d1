"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots; the bytes and rows of every slot are
summed; a versioned table maps slots to shards.  Version 0 deals slots, largest first,
to the least loaded shard.  ``add_shard`` edits the map: it writes a new version in which
slots move only to the new shard.  Readers need the record hash and the map only.

Defined cases: null text has size 1 and CRC 0; null ids and equal rows are ordinary
records (equal rows of one input partition are numbered, and the number is hashed too,
so one record repeated many times spreads over all slots); an empty table gives no rows;
other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored, utf8_size
from tessera.sources.tables import table

SLOTS = 8192
SHARDS = 8


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, copy, virtual_slot."""
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), (utf8_size(text_col) + 1).alias("size"),
        F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.spark_partition_id().alias("part"))
    counted = keyed.groupBy("doc_id", "size", "text_crc32", "part").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
    return rows.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "size", "text_crc32", "copy"), F.lit(slots)).cast("int"))


def slot_map(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 0 of the map: (version, virtual_slot, shard, bytes, rows), at most one row per slot.

    The fold runs over one row that holds the slot sums (at most ``SLOTS`` of them).
    """
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    least = "cast(array_position(s.loads, array_min(s.loads)) as int) - 1"
    dealt = sums.agg(F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "bytes", "rows")))
                     .alias("slots")).withColumn("owner", F.expr(f"""
        aggregate(slots, named_struct('loads', array_repeat(0L, {shards}), 'owner', cast(array() as array<int>)),
                  (s, x) -> named_struct('loads', transform(s.loads, (l, i) -> if(i = {least}, l + x.bytes, l)),
                                         'owner', array_append(s.owner, {least})),
                  s -> s.owner)"""))
    return dealt.select(F.inline(F.arrays_zip("slots", "owner"))).select(
        F.lit(0).alias("version"), "slots.virtual_slot", F.col("owner").alias("shard"), "slots.bytes", "slots.rows")


def add_shard(current: DataFrame) -> DataFrame:
    """The next version of the map with one more shard.

    Every shard gives slots, in hash order, as long as it keeps at least the new mean
    load; all of them go to the new shard.  At most ``SLOTS`` rows are involved.
    """
    load = current.groupBy("shard").agg(F.sum("bytes").alias("load"))
    goal = load.agg((F.sum("load") / (F.max("shard") + 2)).alias("goal"), (F.max("shard") + 1).alias("new_shard"))
    row = goal.first()
    order = Window.partitionBy("shard").orderBy(F.xxhash64("virtual_slot"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    moves = F.col("load") - F.sum("bytes").over(order) >= F.lit(float(row["goal"] or 0))
    return current.join(load, "shard").select(
        (F.col("version") + 1).alias("version"), "virtual_slot",
        F.when(moves, F.lit(int(row["new_shard"] or 0))).otherwise(F.col("shard")).cast("int").alias("shard"), "bytes", "rows")


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard of every row, its place in the shard (gapless from 0) and its shard after one more is added."""
    rows = stored(records(docs, slots, id_col, text_col), "shard-rows")
    first = stored(slot_map(rows, shards), "slot-map")
    grown = stored(add_shard(first), "slot-map")
    in_shard = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    places = (first.withColumn("base", F.coalesce(F.sum("rows").over(in_shard), F.lit(0)))
              .join(grown.select("virtual_slot", F.col("shard").alias("next_shard")), "virtual_slot")
              .select("virtual_slot", "shard", "base", "next_shard", F.col("version").alias("map_version")))
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "part", "copy")
    return (rows.withColumn("at", F.row_number().over(in_slot) - 1)
            .join(F.broadcast(places), "virtual_slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("at")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version", "next_shard"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
