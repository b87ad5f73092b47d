"""Token ids of documents as binary files with Elias-Fano boundaries.

The documents are dealt out by ranges of ascending id (rows that share an id by a
number of their own too, so no id fills a task), and each task encodes its own and
writes files of at most ``ids_per_file`` ids, or one longer document. A file
holds, after a header, the ends of its documents among its ids as an Elias-Fano
sequence, the document ids as another one, and the ids one after another, in 16
bits if the vocabulary allows it. Spark's writer puts the bytes in the folder, so
any store that Spark knows will do, and the files of lost tasks never show.

File, little-endian: ``IDS1``, part and file number in the part (32 bits), number
of documents and of those without an id (32), number of ids (64), smallest
document id (64, signed), bytes of an id (8); the ends; the document ids less the
smallest one; the ids; a line feed. Part, then file number, is the order of the
files, so a document's place in the whole is its place in its file after the ids
of the files before.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from functools import lru_cache
from itertools import compress
from math import ceil

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import SPACE, documents, shuffle_width, slices, texts_of, trim, written
from blotter.llm.elias_fano import RATE, EliasFano
from blotter.llm.tokens import PieceCache
from blotter.session import checkpoint_dir

MAGIC = b"IDS1"
_HEAD = struct.Struct("<4sIIIIQqB")
END_ID = 1
#: Ids in a file: 16 MB in 16 bits.
IDS_PER_FILE = 1 << 23


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------ ids


#: What the splitting below is for (fixed values): small letters, white space dropped, words by this pattern.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Classes of bytes: white space, letters, digits, other ASCII, apostrophe, the rest.
_CLASS = np.full(256, 5)
_CLASS[:128] = 3
_CLASS[SPACE] = 0
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[48:58] = 2
_CLASS[39] = 4
#: A word of the pattern ends between these classes, whatever stands around them.
_ENDS = np.zeros((6, 6), bool)
_ENDS[0, :] = _ENDS[:, 0] = True
_ENDS[2, 1:5] = _ENDS[1:5, 2] = True
_ENDS[1, 3:5] = _ENDS[3, 1] = True
_ENDS[0, 0] = False


#: Words that are encoded as one text.
_WORDS_AT_ONCE = 256


def word_pieces(data: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of pieces without white space that no word of ``_PATTERN``
    reaches over: runs of letters, digits, other characters."""
    kind = _CLASS[data]
    cut = np.flatnonzero(_ENDS[kind[:-1], kind[1:]]) + 1
    solid = kind[cut] > 0
    return cut[solid], np.append(cut[1:], len(data))[solid]


class WordEncoder:
    """Ids of texts by a tokenizers vocabulary. If it splits words by
    ``_PATTERN``, distinct pieces are encoded once; a text in which a special
    token might stand, and any text for another vocabulary, is encoded whole."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        self.size = max(tokenizer.get_vocab_size(with_added_tokens=True), max(tokenizer.get_vocab(True).values(), default=0) + 1)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps, cuts = ((spec[k] or {}).get(of, []) for k, of in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")))
        self.pieced = [x["type"] for x in steps] == _NORMAL and bool(cuts) and cuts[0].get("pattern") == {"Regex": _PATTERN}

        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.size, bool)
        if suffix:
            self.ends[[i for word, i in tokenizer.get_vocab(False).items() if word.endswith(suffix)]] = True

        def encode(strings: list[str]) -> list[bytes]:
            return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

        def encode_pieces(strings: list[str]) -> list[bytes]:
            """Runs of letters are words: many are encoded as one text, whose
            ids are told apart by the tokens that end a word."""
            is_word = [s.isascii() and s.isalpha() for s in strings] if suffix else [False] * len(strings)
            words = list(compress(strings, is_word))
            texts = [" ".join(words[i : i + _WORDS_AT_ONCE]) for i in range(0, len(words), _WORDS_AT_ONCE)]
            ids = np.frombuffer(b"".join(encode(texts)), "<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) != len(words):
                raise ValueError("the vocabulary's words do not end where white space does")
            packed, stops = ids.tobytes(), stops.tolist()
            found = iter([packed[a:b] for a, b in zip([0, *stops], stops)])
            rest = iter(encode([s for s, w in zip(strings, is_word) if not w]))
            return [next(found) if w else next(rest) for w in is_word]

        self.whole, self.cache = encode, PieceCache(encode_pieces, {}, word_pieces, lower=True)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        own = [not self.pieced or any(s in t for s in self.special) for t in texts]
        pieced = iter(self.cache([t for t, o in zip(texts, own) if not o]))
        return [np.frombuffer(self.whole([t])[0], "<u4") if o else next(pieced) for t, o in zip(texts, own)]


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# ------------------------------------------------------------------ files


def file_bytes(part: int, number: int, ids: list[int | None], ends: np.ndarray, tokens: bytes, width: int) -> bytes:
    """One file; ``ids`` ascend, those that are null come last."""
    known = np.array([i for i in ids if i is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    head = _HEAD.pack(MAGIC, part, number, len(ids), len(ids) - len(known), int(ends[-1]), least, width)
    # the difference of two 64-bit numbers is exact as an unsigned one
    return b"".join([head, EliasFano.of(ends).to_bytes(), EliasFano.of(known.astype(np.uint64) - np.uint64(least % 2**64)).to_bytes(), tokens])


class TokenFile:
    """A file that was read: ``part``, ``number``, ``n_docs``, ``n_ids``, and by
    document number (from 0) its id, ends and ids."""

    def __init__(self, data: bytes):
        magic, self.part, self.number, self.n_docs, self.n_null, self.n_ids, self.least, self.width = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        self.ends, at = EliasFano.from_bytes(data, _HEAD.size)
        self.known, at = EliasFano.from_bytes(data, at)
        self.tokens = np.frombuffer(data, f"<u{self.width}", self.n_ids, at)

    def bounds(self, a: int, b: int) -> np.ndarray:
        """Places of the first ids of documents a to b - 1, and of the end of the last."""
        first = self.ends.select(a - 1) if a else 0
        return np.concatenate([[first], self.ends.select_range(a, b).astype(np.int64)])

    def doc_ids(self, a: int, b: int) -> list[int | None]:
        n = self.known.n
        found = self.known.select_range(min(a, n), min(b, n)) + np.uint64(self.least % 2**64)
        return [*found.astype(np.int64).tolist(), *[None] * (b - a - len(found))]

    def document(self, k: int) -> np.ndarray:
        a, b = self.bounds(k, k + 1)
        return self.tokens[a:b]


def write_ids(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID,
    ids_per_file: int = IDS_PER_FILE,
) -> None:
    """Writes the ids of ``docs`` to a new folder, documents by ascending id.

    The id is an integer; rows without one come last. Rows that share an id
    stand together in any order, each as a document. A null or empty text is
    its end id alone. An empty table makes a folder without files of ids. Other
    columns are not read.
    """
    spark, path = docs.sparkSession, vocabulary or default_vocabulary()
    own = F.xxhash64(F.monotonically_increasing_id())
    picked = docs.select(F.col(id_col).cast("long").alias("id"), own.alias("own"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    order = [F.col("id").asc_nulls_last(), F.col("own").asc()]
    # a token has some four bytes; a task with more ids writes several files
    dealt = picked.repartitionByRange(max(shuffle_width(spark), ceil(size / 4 / ids_per_file)), *order).sortWithinPartitions(*order)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = _encoder(path)
        width = 2 if max(encoder.size, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], f"<u{width}").tobytes()
        part, number, held, ids, packed = TaskContext.get().partitionId(), 0, 0, [], []

        def file():
            ends = np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)) // width)
            return pa.RecordBatch.from_arrays([pa.array([file_bytes(part, number, ids, ends, b"".join(packed), width)], pa.binary())], names=["value"])

        for batch in slices(batches, "text"):
            for i, found in zip(batch.column("id").to_pylist(), encoder(texts_of(batch.column("text")))):
                if ids and held + len(found) + 1 > ids_per_file:
                    yield file()
                    number, held, ids, packed = number + 1, 0, [], []
                held += len(found) + 1
                ids.append(i)
                packed.append(found.astype(f"<u{width}").tobytes() + end)
        if ids:
            yield file()
        encoder.cache.forget()
        trim()

    files = dealt.select("id", "text").mapInArrow(run, "value binary")
    # the cast takes the bytes as they are; the writer puts one row in a file, and a line feed after it
    files.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)


def read_ids(spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """A row for each document of a folder: id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids in 32 bits) and, ``with_ids``,
    the ids. Documents are found by the select structures of their file, a block
    of ``RATE`` at a time."""
    found = spark.read.format("binaryFile").load(folder).select("content")
    kept = "id long, part long, number long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                if not data:  # of a task without rows
                    continue
                file = TokenFile(data)
                for a in range(0, file.n_docs, RATE * 16):
                    b = min(a + RATE * 16, file.n_docs)
                    bounds = file.bounds(a, b)
                    ids = file.tokens[bounds[0] : bounds[-1]].astype("<u4")
                    raw, at = memoryview(ids).cast("B"), (bounds - bounds[0]).tolist()
                    crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(at, at[1:])]
                    columns = [
                        pa.array(file.doc_ids(a, b), pa.int64()), pa.array([file.part] * (b - a), pa.int64()), pa.array([file.number] * (b - a), pa.int64()),
                        pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in kept.split(", ")])

    rows = written(found.mapInArrow(run, kept), "read-ids")
    # Ids before each file: among a thousand parts, and of the thousands before.
    files = rows.groupBy(F.expr("part div 1000").alias("many"), "part", "number").agg(F.sum("n_tokens").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    many = files.groupBy("many").agg(F.sum("n").alias("n")).select("many", earlier(Window.orderBy("many")).alias("before_many"))
    before = files.select("many", "part", "number", earlier(Window.partitionBy("many").orderBy("part", "number")).alias("before"))
    base = before.join(many, "many").select("part", "number", (F.col("before") + F.col("before_many")).alias("base"))
    start = (F.col("base") + F.col("start")).alias("start")
    return rows.join(base, ["part", "number"]).select(F.col("id").alias(id_col), start, "n_tokens", "ids_crc32", *["ids"] * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-token-files-{uuid.uuid4().hex}"
    write_ids(documents(spark, sf_dir), folder)
    return read_ids(spark, folder)
