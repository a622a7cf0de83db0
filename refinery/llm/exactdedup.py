"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Three steps, each for the rows that are still undecided, in two scans of the texts:

1. the length of the normalised text and the hash of its first ``PREFIX``
   characters, of every row; lengths that occur once are decided;
2. among the others, (length, prefix hash) pairs that occur once are decided;
3. the full hash, evaluated only for rows of the surviving pairs. Their pairs
   reach the scan as a bitmap of fixed size (``BITMAP`` bits), so the full hash
   is taken inside the scan and no text moves. A pair that shares a bit with a
   survivor is hashed as well, which changes nothing: the full hash decides.

Rows that no other row equals go straight to the result. Groups are counted
with map-side partial aggregates and joined back on the hash, a join that
Spark splits when a group is hot.

Equal means equal after deleting the characters ``[\\x20\\x09-\\x0D]``; null
counts as empty. Of equal texts the row with the most code points in the
original text stays, then the smallest doc_id (a null id last), then the row
that comes first in the input files, so of repeated rows exactly one stays.
An empty table gives no rows. Other columns than text and doc_id are read only
where asked for; names that start with two underscores are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, with_row, written

PREFIX = 64
BITMAP = 1 << 20
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def _bit(column_length: Column, column_prefix: Column) -> Column:
    return F.pmod(F.xxhash64(column_length, column_prefix), F.lit(BITMAP))


def _bitmap(pairs: DataFrame) -> bytes:
    """The bits of all pairs: at most BITMAP / 32768 rows of 4096 bytes reach the driver."""
    bit = _bit(F.col("__length"), F.col("__prefix"))
    parts = (pairs.select((bit + 1).alias("b"))       # the bitmap functions count values from 1
             .groupBy(F.call_function("bitmap_bucket_number", F.col("b")).alias("bucket"))
             .agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("b"))).alias("bits")))
    out = bytearray(BITMAP // 8)
    for row in parts.collect():
        start = (row["bucket"] - 1) * 4096
        out[start:start + 4096] = row["bits"]
    return bytes(out)


def _is_set(bits: bytes, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.lit(bits), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.call_function("bit_get", byte.cast("long"), (bit % 8).cast("int")) == 1


def surviving_pairs(docs: DataFrame) -> DataFrame:
    """(length, prefix hash) pairs that more than one row has, found length first."""
    norm = normalised(F.col("text"))
    keys = docs.select(F.length(norm).alias("__length"),
                       F.xxhash64(F.substring(norm, 1, PREFIX)).alias("__prefix"))
    pairs = keys.groupBy("__length", "__prefix").agg(F.count(F.lit(1)).alias("__n"))
    lengths = pairs.groupBy("__length").agg(F.sum("__n").alias("__all")).filter("__all > 1")
    return pairs.join(lengths, "__length", "left_semi").filter("__n > 1").drop("__n")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, the ``carry`` columns and ``__row``, the row's name.

    The bitmap of surviving pairs and one scan that writes what is decided about
    each row, without its text, run while this is called.
    """
    bits = _bitmap(surviving_pairs(docs.select(F.col(text).alias("text"))))
    norm = normalised(F.col(text))
    pair = _bit(F.length(norm), F.xxhash64(F.substring(norm, 1, PREFIX)))
    rows = written(with_row(docs).select(
        ROW, F.col(doc_id).alias("doc_id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("__chars"),
        F.when(_is_set(bits, pair), F.sha2(norm.cast("binary"), 256)).alias("__full"), *carry), "hashes")
    rank = F.struct((-F.col("__chars")).alias("chars"), F.col("doc_id").isNull().alias("no_id"),
                    F.col("doc_id").alias("id"), F.col(ROW).alias("row"))
    # written, so that the join below has an exchange on both sides and Spark can split a hot group
    groups = written(rows.filter("__full is not null").groupBy("__full").agg(
        F.min(rank).alias("__best"), F.count(F.lit(1)).alias("group_size")), "groups")
    several = (rows.filter("__full is not null").join(groups, "__full")
               .withColumn("keep_id", F.col("__best.id")).withColumn("kept", F.col(ROW) == F.col("__best.row")))
    alone = (rows.filter("__full is null")
             .withColumn("keep_id", F.col("doc_id")).withColumn("group_size", F.lit(1).cast("long"))
             .withColumn("kept", F.lit(True)))
    out = ["doc_id", "keep_id", "group_size", "kept", *carry, ROW]
    return several.select(*out).unionByName(alone.select(*out))


def without_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` less the rows of equal texts that do not stay."""
    rows = with_row(docs)
    dropped = exact_dedup(rows, text, doc_id).filter(~F.col("kept")).select(ROW)
    return rows.join(dropped, ROW, "left_anti").select(*docs.columns)
