"""A Bloom filter that Spark fills and every task probes.

It is broadcast; its size is bounded whatever the data. A fuller filter lets
more rows pass, and every user of it decides exactly on what passes.
"""

from __future__ import annotations

from math import ceil, log2

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter, 128 MB at most.
MAX_LOG2_BITS = 30
BITS_PER_ENTRY = 16
_BLOCK = 32768


class Filter:
    """A Bloom filter of 64-bit hashes in blocks, two bits for each. The bits
    are set in Spark; the driver gets ``2 ** MAX_LOG2_BITS`` bits at most."""

    def __init__(self, hashes: DataFrame, entries: int):
        log2_bits = min(max(15, ceil(log2(max(entries, 1) * BITS_PER_ENTRY))), MAX_LOG2_BITS)
        self.blocks = 2**log2_bits // _BLOCK
        h = F.col("h")
        slot = lambda by: F.shiftrightunsigned(h, by).bitwiseAND(F.lit(_BLOCK - 1)).cast("long")
        hits = hashes.select(
            F.pmod(h, F.lit(self.blocks)).cast("int").alias("block"), F.explode(F.array(slot(33), slot(48))).alias("slot")
        )
        rows = hits.groupBy("block").agg(F.expr("bitmap_construct_agg(slot)").alias("bits")).collect()
        bits = np.zeros((self.blocks, _BLOCK // 8), np.uint8)
        for r in rows:
            bits[r.block] = np.frombuffer(r.bits, np.uint8)
        self.shared = hashes.sparkSession.sparkContext.broadcast(bits)

    def __getstate__(self):
        return {"blocks": self.blocks, "shared": self.shared}

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        h, bits = hashes.view(np.uint64), self.shared.value
        block = (h & np.uint64(self.blocks - 1)).astype(np.int64)
        out = np.ones(len(h), bool)
        for by in (33, 48):
            slot = ((h >> np.uint64(by)) & np.uint64(_BLOCK - 1)).astype(np.int64)
            out &= (bits[block, slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
        return out
