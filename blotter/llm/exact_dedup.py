"""Exact de-duplication by two passes of a Bloom filter, DataFrame operations only.

Texts are equal when they are identical after each run of space and
\\x09-\\x0D became one space. Pass one counts hits on the slots of a blocked
Bloom filter and keeps, as bitmaps, the slots that were hit twice or more.
Pass two probes it: a row whose slots were not all hit twice cannot repeat and
passes straight through; only the others are shuffled and grouped by SHA-256.

The filter is broadcast. Its size is bounded by construction, whatever the
data: ``2 ** max_log2_slots`` bits. A fuller filter lets more rows be shuffled,
never changes a result.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import documents, written

#: Bits in a row of the filter table (fixed by bitmap_construct_agg).
BLOCK_BITS = 32768
#: 64 MB of bitmaps at most.
MAX_LOG2_SLOTS = 29
SLOTS_PER_ROW = 16


def normalised(text: Column) -> Column:
    """Null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _probes(blocks: int) -> list[Column]:
    """Block and the two slots in it, from the digest column ``sha``."""
    h = F.xxhash64("sha")
    return [
        F.pmod(h, F.lit(blocks)).cast("int").alias("block"),
        F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("long").alias("slot1"),
        F.shiftrightunsigned(h, 48).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("long").alias("slot2"),
    ]


def repeat_filter(hashed: DataFrame, blocks: int) -> DataFrame:
    """Pass one: (block, bits) with a bit for each slot hit twice or more.
    Hits are summed map-side, so a hash of any frequency is a row per task."""
    hits = hashed.select(*_probes(blocks)).select(
        "block", F.explode(F.array_distinct(F.array("slot1", "slot2"))).alias("slot")
    )
    twice = hits.groupBy("block", "slot").agg(F.count(F.lit(1)).alias("hits")).filter("hits > 1")
    return twice.groupBy("block").agg(F.expr("bitmap_construct_agg(slot)").alias("bits"))


def _bit(slot: str) -> Column:
    byte = F.expr(f"cast(conv(hex(substring(bits, cast({slot} div 8 as int) + 1, 1)), 16, 10) as int)")
    return F.expr("true") & (F.call_function("shiftright", byte, F.expr(f"cast({slot} % 8 as int)")).bitwiseAND(F.lit(1)) == 1)


def mark_suspects(hashed: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """Pass two: ``hashed`` with ``suspect``, true for rows that may repeat."""
    probed = hashed.select("*", *_probes(blocks)).join(F.broadcast(bits), "block", "left")
    return probed.withColumn("suspect", F.coalesce(_bit("slot1") & _bit("slot2"), F.lit(False))).drop(
        "block", "slot1", "slot2", "bits"
    )


def blocks_for(rows: int, max_log2_slots: int = MAX_LOG2_SLOTS) -> int:
    want = max(15, ceil(log2(max(rows, 1) * SLOTS_PER_ROW)))
    return 2 ** min(want, max_log2_slots) // BLOCK_BITS


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_log2_slots: int = MAX_LOG2_SLOTS) -> DataFrame:
    """A row for each row of ``docs``: id, keep_id (the smallest id with an
    equal text), group_size, kept, text_sha256.

    Null texts count as empty texts. Null ids are larger than any other; a
    group with null ids alone has keep_id null and its rows are kept. Rows
    that repeat an id and its text share one answer. An empty table gives an
    empty result. Other columns are not read.
    """
    hashed = written(docs.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("sha")), "hashed")
    blocks = blocks_for(hashed.count(), max_log2_slots)
    marked = mark_suspects(hashed, repeat_filter(hashed, blocks), blocks)
    alone = marked.filter("not suspect").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha"
    )
    suspects = written(marked.filter("suspect").select("id", "sha"), "suspects")
    groups = written(
        suspects.groupBy("sha").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    repeated = suspects.join(groups, "sha").select("id", "keep_id", "group_size", "sha")
    return alone.unionByName(repeated).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_log2_slots: int = MAX_LOG2_SLOTS) -> DataFrame:
    """The rows of ``docs``, with their columns, one for each distinct text:
    the row with the smallest id (null last); of rows that repeat that id and
    text, any one. Rows that cannot repeat are not shuffled."""
    names, row, sha = docs.columns, "__row", "sha"
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias(row),
        F.col(id_col).alias("id"),
        F.sha2(normalised(F.col(text_col)), 256).alias(sha),
    )
    hashed = written(packed.select("id", sha), "hashed")
    blocks = blocks_for(hashed.count(), max_log2_slots)
    bits = written(repeat_filter(hashed, blocks), "filter")
    suspects = mark_suspects(hashed, bits, blocks).filter("suspect")
    keep = written(suspects.groupBy(sha).agg(F.min("id").alias("keep_id")), "groups")
    marked = mark_suspects(packed, bits, blocks)
    alone = marked.filter("not suspect").select(row)
    repeated = (
        marked.filter("suspect").join(keep, sha).filter(F.col("id").eqNullSafe(F.col("keep_id")))
        .groupBy(sha).agg(F.first(row).alias(row)).select(row)
    )
    return alone.unionByName(repeated).select(*[F.col(row)[c].alias(c) for c in names])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_groups(documents(spark, sf_dir))


SQL = r"""
WITH n AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
FROM n
"""
