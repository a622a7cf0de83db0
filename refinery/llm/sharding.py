"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records hash into ``SLOTS`` virtual slots, for good. Bytes are summed per slot,
and a map says which shard holds a slot. The first map gives the largest slot to
the least filled shard, one by one; a later version is the earlier one, edited:
every shard keeps its slots, largest first, as far as its share goes, and only
the rest is dealt again. So bytes stay near equal and few slots move.

All of it is DataFrame functions. What is handled as one array is the table of
slots, ``SLOTS`` rows whatever the corpus. A record's place in its shard counts
the records of the shard's earlier (slot, lane) pairs; lanes come from the input
partition, so a slot that many equal rows share is numbered by many tasks.

Law ``bytes``: shards hold near equal bytes (UTF-8 bytes of the text plus one).

Defined cases: a null text has size 1 and the checksum of no bytes; a null
doc_id hashes by its text; repeated rows share a slot and get places of their
own; an empty table gives no rows and a map of empty slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, written

SLOTS = 4096
LANES = 16


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual slot and lane of every row, written once."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return written(docs.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int").alias("vslot"),
        F.pmod(F.spark_partition_id(), F.lit(LANES)).alias("lane")), "records")


def slot_bytes(recs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(vslot, bytes) of all slots, empty ones too."""
    filled = recs.groupBy("vslot").agg(F.sum("size").alias("bytes"))
    return (recs.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
            .join(filled, "vslot", "left").select("vslot", F.coalesce("bytes", F.lit(0)).alias("bytes")))


def _deal(pool: Column, loads: Column) -> Column:
    """Shard numbers for the pool's (bytes, vslot), in order: each to the least filled shard."""
    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("out"))

    def put(acc: Column, slot: Column) -> Column:
        to = F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int") - 1
        return F.struct(F.transform(acc["loads"], lambda x, i: x + F.when(i == to, slot["bytes"]).otherwise(F.lit(0))).alias("loads"),
                        F.concat(acc["out"], F.array(to)).alias("out"))

    return F.aggregate(pool, start, put, lambda acc: acc["out"])


def edited_map(sizes: DataFrame, shards: int, before: DataFrame | None = None) -> DataFrame:
    """(vslot, shard, bytes) of all slots: ``before`` with as few slots moved as near equal bytes need."""
    spark = sizes.sparkSession
    held = (sizes.withColumn("shard", F.lit(None).cast("int")) if before is None
            else sizes.join(before.select("vslot", "shard"), "vslot", "left"))
    share = F.sum("bytes").over(Window.partitionBy(F.lit(0))) / shards     # the table of slots has a fixed size
    upto = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot").rowsBetween(Window.unboundedPreceding, 0)
    marked = held.withColumn("stays", F.coalesce(
        (F.col("shard") < shards) & (F.sum("bytes").over(upto) <= share), F.lit(False)))
    kept = marked.filter("stays")
    loads = (spark.range(shards).select(F.col("id").cast("int").alias("shard"))
             .join(kept.groupBy("shard").agg(F.sum("bytes").alias("b")), "shard", "left")
             .agg(F.array_sort(F.collect_list(F.struct("shard", F.coalesce("b", F.lit(0)).alias("b")))).alias("l"))
             .select(F.transform("l", lambda x: x["b"]).alias("loads")))
    pool = marked.filter(~F.col("stays")).agg(F.sort_array(
        F.collect_list(F.struct("bytes", (-F.col("vslot")).alias("minus"))), asc=False).alias("pool"))
    dealt = (pool.join(loads, F.lit(True))                                  # one row and one row
             .select(F.explode(F.arrays_zip(F.col("pool"), _deal(F.col("pool"), F.col("loads")).alias("to"))).alias("z"))
             .select((-F.col("z.pool.minus")).cast("int").alias("vslot"), F.col("z.to").alias("shard"), F.col("z.pool.bytes").alias("bytes")))
    return kept.select("vslot", "shard", "bytes").unionByName(dealt)


def store_map(slot_map: DataFrame, folder: str, version: int) -> DataFrame:
    """Write a version; earlier ones stay as they are."""
    slot_map.coalesce(1).write.mode("error").parquet(f"{folder}/version={version}")
    return read_map(slot_map.sparkSession, folder, version)


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema("vslot int, shard int, bytes long").parquet(f"{folder}/version={version}")


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with their shard and a gapless place in it (``slot``, from 0)."""
    # both tables have a fixed size: SLOTS rows, and SLOTS x LANES rows
    groups = recs.groupBy("vslot", "lane").agg(F.count(F.lit(1)).alias("n")).join(
        F.broadcast(slot_map.select("vslot", "shard")), "vslot")
    earlier = Window.partitionBy("shard").orderBy("vslot", "lane").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("vslot", "lane", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("vslot", "lane").orderBy("doc_id", "text_crc32", "size"))
    return (recs.withColumn("__nth", within).join(F.broadcast(bases), ["vslot", "lane"])
            .withColumn("slot", F.col("base") + F.col("__nth") - 1).drop("base", "__nth"))


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, vslot, law, shard, slot; version 1 of the map is stored in ``folder``.

    The jobs for the records and the map run while this is called.
    """
    recs = records(docs, slots)
    slot_map = store_map(edited_map(slot_bytes(recs, slots), shards), folder or scratch(docs.sparkSession, "slot-map"), 1)
    return place(recs, slot_map).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", "vslot")
