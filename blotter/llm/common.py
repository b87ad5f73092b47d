"""Shared helpers of the corpus operators: written tables, Arrow batches, words.

Words are the runs of bytes other than space and \\x09-\\x0D. They are found
and hashed for a whole batch at once with numpy; hashes are 64 bits wide.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from blotter.session import checkpoint_dir

#: Bytes that separate words.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: A-Z to a-z; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_BYTE = np.random.default_rng(20240517).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
#: Longer words are hashed by hashlib.
_LONG_WORD = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, tag: str, **options) -> DataFrame:
    """``df`` written once in the shared folder of ``spark.checkpoint.dir``
    and read back: the lineage ends, and the rows survive lost executors."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches, text_at: int | str, most_bytes: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Rows in order, in slices of about ``most_bytes`` of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(size.astype(np.int64)) - 1) // most_bytes
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def texts_of(column: pa.Array) -> list[str]:
    """Null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def trim() -> None:
    """Gives freed memory back to the machine, at the end of a task: the worker
    lives on beside the tasks of later stages."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def with_text_columns(df: DataFrame, fields: str, fn: Callable[[list[str]], list], text: str = "text") -> DataFrame:
    """``df`` with the columns of ``fields`` (DDL) added at the end, in place
    of columns with these names; ``fn`` gets the texts of some rows and returns
    one sequence for each field."""
    added = StructType.fromDDL(fields)
    taken = {f.name.lower() for f in added.fields}
    df = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])
    schema = StructType([*df.schema.fields, *added.fields])
    at = df.columns.index(text)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(added)
        for part in slices(batches, at):
            columns = fn(texts_of(part.column(at)))
            new = [pa.array(c, type=f.type) for c, f in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *types.names])
        trim()

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[str, np.ndarray] = {}
#: Powers that a worker keeps from one batch to the next.
_KEPT_POWERS = 1 << 21


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                p = np.full(n, base)
                p[0] = 1
                _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """Words of some texts: ``start``, ``end`` (in ``data``), ``doc``, ``hash``;
    ``first[d]:first[d + 1]`` are those of text d."""

    def __init__(self, texts: list[str], lower: bool = False):
        blobs = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join([b"", *blobs, b""]), np.uint8)
        self.data = data = LOWER[data] if lower else data
        space = SPACE[data]
        turn = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.start, self.end = turn[::2], turn[1::2]
        at = np.cumsum([1, *(len(b) + 1 for b in blobs)])
        self.first = np.searchsorted(self.start, at)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hash = span_hashes(data, self.start, self.end)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings ``data[start:end]``."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    length = (end - start).astype(np.uint64)
    out = mix((total[end] - total[start]) * down[start] + length * np.uint64(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(length > _LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    if len(up) > _KEPT_POWERS:  # after a very long text
        _POWERS.clear()
    return out


def meets(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span (start, end) overlaps any of the ``spans``, found by
    bisection among their union."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def test(a: int, b: int) -> bool:
        k = bisect_left(starts, b)
        return k > 0 and ends[k - 1] > a

    return test


def joined_hash(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of the sequence of the given hashes, element by element."""
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + p)
    return out


def id_type(df: DataFrame, name: str):
    return df.schema[name].dataType if name in df.columns else LongType()


def null_safe_min_first(name: str):
    """Sort key that puts null ids last."""
    return F.struct(F.col(name).isNull(), F.col(name))
