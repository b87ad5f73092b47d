"""Best-two-fit packing of documents into sequences of bounded length.

Pieces of equal length are interchangeable, so the bins are planned on counts
by length alone, at most ``max_len`` of them however many documents there are.
A bin is filled greedily with the largest pieces that fit; then its smallest
piece is replaced by the two unpacked pieces that fill its expanded gap most
tightly, if they leave less of it. The same choice would be made again until a
length runs out, so it is repeated that often at once. Pieces then find their
places by their rank among those of their length.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import documents, slices, texts_of, trim, written
from blotter.llm.tokens import SPLIT, PieceCache, Vocabulary, default_vocabulary

MAX_LEN = 1024
END_ID = 2


# ------------------------------------------------------------------ plan


def best_pair(count: np.ndarray, room: int) -> tuple[int, int]:
    """The two available lengths with the largest sum of at most ``room``
    (0, 0: none); of equal sums, the one with the longest piece."""
    have = np.flatnonzero(count[: room + 1] > 0)
    have = have[have > 0]
    if not len(have):
        return 0, 0
    at = np.searchsorted(have, room - have, "right") - 1
    at = np.where((at >= 0) & (have[np.maximum(at, 0)] == have) & (count[have] < 2), at - 1, at)
    total = np.where(at >= 0, have + have[np.maximum(at, 0)], 0)
    k = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(have[k]), int(have[at[k]])) if total[k] else (0, 0)


def fill_bin(count: np.ndarray, max_len: int) -> tuple[list[int], np.ndarray]:
    """Lengths in the next bin and the most pieces of each length that were
    held on the way."""
    left = count.copy()
    gap, lengths = max_len, []
    held = np.zeros_like(count)
    while True:
        fits = np.flatnonzero(left[1 : gap + 1])
        if not len(fits):
            break
        longest = int(fits[-1]) + 1
        lengths.append(longest)
        left[longest] -= 1
        held[longest] += 1
        gap -= longest
    if len(lengths) > 1 and gap:
        smallest = lengths[-1]
        a, b = best_pair(left, gap + smallest)
        if a + b > smallest:
            lengths[-1:] = [max(a, b), min(a, b)]
            used = np.bincount([a, b], minlength=len(count))
            held = np.maximum(held, held - np.bincount([smallest], minlength=len(count)) + used)
    return lengths, held


def plan(count: np.ndarray, max_len: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs of equal bins as (length, first rank, end rank, pieces of the
    length in a bin, first bin, offset in the bin)."""
    count = count.copy()
    rank = np.zeros_like(count)
    runs, bins = [], 0
    while count.any():
        lengths, held = fill_bin(count, max_len)
        some = np.flatnonzero(held)
        times = int((count[some] // held[some]).min())
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            each = lengths.count(length)
            first = int(rank[length])
            runs.append((length, first, first + each * times, each, bins, offset))
            rank[length] += each * times
            count[length] -= each * times
            offset += each * length
        bins += times
    return runs


# ------------------------------------------------------------------ pieces


@lru_cache(maxsize=2)
def _library(path: str) -> PieceCache:
    """A tokenizer library behind the cache of pieces, one for each worker. A
    vocabulary whose ids ascend with its merges is read as ranks by tiktoken,
    which encodes short strings several times faster than tokenizers and to the
    same ids."""
    vocabulary = Vocabulary(path)
    made = [w for _, _, w in vocabulary.merges]
    if made == sorted(made):
        import tiktoken

        ranks = {label: i for i, label in vocabulary.label.items() if i not in vocabulary.special.values()}
        ordinary = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        def encode(strings: list[str]) -> list[bytes]:
            return [np.array(ids, "<u4").tobytes() for ids in map(ordinary, strings)]
    else:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        tokenizer.encode_special_tokens = True  # the cache has set those apart

        def encode(strings: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    return PieceCache(encode, vocabulary.special)


def cut_pieces(n: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter."""
    first = n % max_len or min(n, max_len)
    return [(0, first), *((s, max_len) for s in range(first, n, max_len))]


_PIECES = "piece int, start long, length long, ids_crc32 long, part long, rank_in_part long"


def pieces(docs: DataFrame, id_col: str, text_col: str, max_len: int, end_id: int, path: str) -> DataFrame:
    """The pieces of each row with their rank among those of their length in
    their part (that is, the task that made them)."""
    from pyspark.sql.types import StructField, StructType

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([StructField("id", picked.schema["id"].dataType), *StructType.fromDDL(_PIECES).fields])
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        part = TaskContext.get().partitionId()
        seen = np.zeros(max_len + 1, np.int64)
        types = to_arrow_schema(schema)
        for batch in slices(batches, "text"):
            row, out = [], []
            for i, ids in enumerate(_library(path)(texts_of(batch.column("text")))):
                packed = ids.tobytes() + end
                for k, (start, length) in enumerate(cut_pieces(len(packed) // 4, max_len)):
                    crc = zlib.crc32(packed[4 * start : 4 * (start + length)])
                    row.append(i)
                    out.append((k, start, length, crc, part, int(seen[length])))
                    seen[length] += 1
            columns = [batch.column("id").take(pa.array(row, pa.int64())), *map(list, zip(*out))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, types)], names=types.names)
        _library(path).forget()
        trim()

    return picked.mapInArrow(run, schema)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN, end_id: int = END_ID,
    vocabulary: str | None = None,
) -> DataFrame:
    """A row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id alone. Rows that repeat, or whose id is
    null, are packed each. An empty table gives no rows. Other columns are not
    read. The driver gets ``max_len`` counts and makes the plan from them.
    """
    from pyspark.sql import Window

    path = vocabulary or default_vocabulary()
    made = written(pieces(docs, id_col, text_col, max_len, end_id, path), "pieces")
    by_part = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(by_part.select("part", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "offsets")
    count = np.zeros(max_len + 1, np.int64)
    for length, n in offsets.groupBy("length").agg(F.sum("n")).collect():
        count[length] = n
    runs = sorted(plan(count, max_len))
    keys = np.array([r[0] << 44 | r[1] for r in runs], np.int64)
    table = np.array(runs, np.int64).reshape(-1, 6)

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = table[np.searchsorted(keys, length << 44 | rank, "right") - 1]
            nth = rank - run[:, 1]
            kept = [batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")]
            where = [pa.array(run[:, 4] + nth // run[:, 3]), pa.array(run[:, 5] + nth % run[:, 3] * length)]
            yield pa.RecordBatch.from_arrays([*kept, *where], names=[id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = made.join(offsets.drop("n"), ["part", "length"]).withColumn("rank", F.col("before") + F.col("rank_in_part"))
    schema = (
        made.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32")
        .withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    )
    return ranked.select("id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
