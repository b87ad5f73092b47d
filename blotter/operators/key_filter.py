"""A Bloom filter as a small table, applied by a broadcast join.

The keys of one side set bits of ``SLOTS`` 64-bit words: a word chosen by one part
of the key's hash, ``BITS`` bits in it by others. The table (slot, mask) has at
most that many rows whatever the number of keys, so it may always be broadcast; a
row of the other side passes if its bits are set in its word. A key that was put in
always passes; of others, the fuller the filter, the more do. Everything is native.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of the filter: at most 16 MB as rows of the table.
SLOTS = 1 << 19
BITS = 3


def row_hash(columns: Sequence[Column], seed: int = 0) -> Column:
    """64 bits of the values, nulls told apart from each other and from values."""
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *columns)


def _place(hashed: Column, slots: int) -> tuple[Column, Column]:
    bit = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 40 + 8 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(BITS)]
    mask = bit[0]
    for b in bit[1:]:
        mask = mask.bitwiseOR(b)
    return F.pmod(hashed, F.lit(slots)).cast("int"), mask


def key_filter(hashes: DataFrame, hash_col: str = "h", slots: int = SLOTS) -> DataFrame:
    """(slot, mask) of the hashes; at most ``slots`` rows, summed up map-side."""
    slot, mask = _place(F.col(hash_col), slots)
    return hashes.select(slot.alias("slot"), mask.alias("mask")).groupBy("slot").agg(F.bit_or("mask").alias("mask"))


def passing(df: DataFrame, hashed: Column, table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The rows of ``df`` whose hash the filter may hold."""
    slot, mask = _place(hashed, slots)
    known = F.broadcast(table.select(F.col("slot").alias("_slot"), F.col("mask").alias("_mask")))
    hit = (slot == F.col("_slot")) & (F.col("_mask").bitwiseAND(mask) == mask)
    return df.join(known, hit).drop("_slot", "_mask")


def with_verdict(df: DataFrame, hashed: Column, table: DataFrame, verdict: str, slots: int = SLOTS) -> DataFrame:
    """``df`` with the column ``verdict``: may the filter hold the row's hash?"""
    slot, mask = _place(hashed, slots)
    known = F.broadcast(table.select(F.col("slot").alias("_slot"), F.col("mask").alias("_mask")))
    held = F.coalesce(F.col("_mask").bitwiseAND(mask) == mask, F.lit(False))
    return df.join(known, slot == F.col("_slot"), "left").withColumn(verdict, held).drop("_slot", "_mask")
