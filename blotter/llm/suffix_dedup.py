"""Removal of byte strings that occur again anywhere in the corpus.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts at
another place. Every such string (window) is assigned to its anchor, the
smallest hash of the ``GRAM``-byte strings in it; equal windows have equal
anchors at the same place. Neighbouring windows with one anchor make a segment.
Anchors that occur once are set aside by a Bloom filter of those that do not;
its size is bounded, what it lets through is counted exactly.

Equal segments are one string with a count; with a count of two or more all its
windows repeat. Different segments of an anchor, aligned there, are compared by
the transform of their collection (``collection_bwt``): windows repeat where a
common prefix has ``WINDOW`` symbols. Anchors with more than ``MOST_STRINGS`` different segments
would fill a task; their windows are counted by hash, spread over all tasks.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from blotter.llm.bloom import Filter
from blotter.llm.collection_bwt import AlignedTransform
from blotter.llm.common import _BYTE, _powers, documents, mix, slices, texts_of, written

WINDOW = 200
GRAM = 48
#: Strings in a collection, and of one anchor at most.
STRINGS, MOST_STRINGS = 1500, 4000
#: Texts are read in stretches of so many windows, whose hashes fit a cache.
STRETCH = 200_000
_ORDER = np.uint64(0xD1342543DE82EF95)

_SEGMENT = "anchor long, offset int, windows int, hash long"
SEGMENT = ["anchor", "offset", "windows", "hash"]


# ------------------------------------------------------------------ segments


def _stretches(blobs: list[bytes], window: int):
    """Lists of (text, first byte, bytes), each of two stretches at most."""
    held, size = [], 0
    for i, blob in enumerate(blobs):
        for a in range(0, max(len(blob) - window + 1, 0), STRETCH):
            part = blob[a : a + STRETCH + window - 1]
            if size + len(part) > 2 * STRETCH and held:
                yield held
                held, size = [], 0
            held.append((i, a, part))
            size += len(part)
    if held:
        yield held


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, from those of powers of two."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(blobs: list[bytes], window: int = WINDOW, gram: int = GRAM):
    """Arrays text, start (byte), anchor, offset (of the anchor), windows and
    hash of the segments of some texts, and a function that gives the bytes of
    chosen ones. Every window of every text is in one segment."""
    out, parts = [], []
    for held in _stretches(blobs, window):
        data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
        size = np.array([len(p) for _, _, p in held])
        begin = np.cumsum(size) - size
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
        grams = (total[gram:] - total[:-gram]) * down[: len(data) - gram + 1]
        place = np.uint64((1 << 24) - 1)
        ranked = grams * _ORDER
        ranked &= ~place
        ranked |= np.arange(len(grams), dtype=np.uint64)
        minima = _window_minima(ranked, window - gram + 1)
        valid = np.zeros(len(data) + 1, np.int8)
        valid[begin] += 1
        valid[begin + size - window + 1] -= 1
        at = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
        anchor = (minima[at] & place).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        lo, anchor = at[first], anchor[first]
        windows = np.diff(np.append(first, len(at)))
        length = windows + window - 1
        body = mix((total[lo + length] - total[lo]) * down[lo] + length.astype(np.uint64))
        k = np.searchsorted(begin, lo, "right") - 1
        text, shift = (np.array([h[x] for h in held], np.int64)[k] for x in (0, 1))
        out.append((text, lo - begin[k] + shift, mix(grams[anchor]).view(np.int64), anchor - lo, windows, body.view(np.int64)))
        parts.append((data, lo, length))
    sizes = np.cumsum([0, *(len(o[0]) for o in out)])

    def content(chosen: np.ndarray) -> list[bytes]:
        found = []
        for (data, lo, length), a, b in zip(parts, sizes, sizes[1:]):
            raw = data.tobytes()
            found += [raw[lo[i] : lo[i] + length[i]] for i in chosen[(chosen >= a) & (chosen < b)] - a]
        return found

    if not out:
        return [np.zeros(0, np.int64)] * 6, content
    return [np.concatenate(x) for x in zip(*out)], content


# ------------------------------------------------------------------ places


def _place_hash(key: np.ndarray, start: np.ndarray) -> np.ndarray:
    return mix(key.view(np.uint64) + mix(start.astype(np.uint64) + np.uint64(1))).view(np.int64)


def _place_hashes(places: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            h = _place_hash(b.column("key").to_numpy(), b.column("start").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(h)], names=["h"])

    return places.select("key", "start").mapInArrow(run, "h long")


# ------------------------------------------------------------------ passes


def _blobs(batch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts_of(batch.column("text"))]


def _anchor_counts(docs: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for batch in slices(batches, "text"):
            found, _ = segments(_blobs(batch), window)
            anchor, n = np.unique(found[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n.astype(np.int64))], names=["h", "n"])

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")


def _occurrences(docs: DataFrame, keep: Filter, window: int) -> DataFrame:
    """The segments whose anchor may repeat, with the key and place of each."""

    def run(batches):
        for batch in slices(batches, "text"):
            (text, start, *segment), _ = segments(_blobs(batch), window)
            some = np.flatnonzero(keep.holds(segment[0]))
            yield _rows(batch, text[some], start[some], [x[some] for x in segment])

    return docs.select("key", "key2", "text").mapInArrow(run, f"key long, key2 long, start long, {_SEGMENT}")


def _rows(batch, text, start, segment, *more):
    at = pa.array(text, pa.int64())
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    columns = [batch.column("key").take(at), batch.column("key2").take(at), pa.array(start, pa.int64()), *(pa.array(x, t) for x, t in zip(segment, types)), *more]
    return pa.RecordBatch.from_arrays(columns, names=["key", "key2", "start", *SEGMENT, *["content"] * len(more)])


def _contents(docs: DataFrame, places: Filter, window: int) -> DataFrame:
    """The segments at the places that the filter holds, with their bytes."""

    def run(batches):
        for batch in slices(batches, "text"):
            (text, start, *segment), content = segments(_blobs(batch), window)
            key = batch.column("key").to_numpy()
            some = np.flatnonzero(places.holds(_place_hash(key[text], start)))
            yield _rows(batch, text[some], start[some], [x[some] for x in segment], pa.array(content(some), pa.binary()))

    return docs.select("key", "key2", "text").mapInArrow(run, f"key long, key2 long, start long, {_SEGMENT}, content binary")


_FOUND = f"{_SEGMENT}, a array<int>, b array<int>"


def _compared(strings: DataFrame, window: int) -> DataFrame:
    """Repeated spans (a, b) of the segments, compared within collections that
    hold all segments of an anchor."""

    def run(batches):
        held: list = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            anchor = table.column("anchor").to_numpy()
            whole = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0
            if whole >= STRINGS:
                yield from _collections(table.slice(0, whole), window)
                held = table.slice(whole).to_batches()
        if held:
            yield from _collections(pa.Table.from_batches(held).combine_chunks(), window)

    spark = strings.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(strings.count() / (2 * STRINGS)))
    return strings.repartition(width, "anchor").sortWithinPartitions("anchor").mapInArrow(run, _FOUND)


def _collections(table: pa.Table, window: int):
    anchor = table.column("anchor").to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(anchor)) + 1).tolist(), len(anchor)]
    group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    start = 0
    for e, after in zip(edges[1:], [*edges[2:], None]):
        if after is None or after - start > STRINGS:
            part = table.slice(start, e - start)
            strings = part.column("content").to_pylist()
            if strings:
                offset = part.column("offset").to_numpy().astype(np.int64)
                with AlignedTransform(strings, offset, group[start:e], window) as t:
                    which, begin = t.repeated_starts()
                yield _spans(part, which, begin, window)
            start = e


def _spans(part: pa.Table, which: np.ndarray, begin: np.ndarray, window: int):
    """Starts, by string, as spans of bytes."""
    order = np.lexsort((begin, which))
    which, begin = which[order], begin[order]
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (begin[1:] != begin[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first, len(which))[1:] - 1
    edge = np.searchsorted(which[first], np.arange(part.num_rows + 1)).astype(np.int32)
    a, b = (pa.ListArray.from_arrays(pa.array(edge), pa.array(x.astype(np.int32))) for x in (begin[first], begin[last] + window))
    columns = [part.column(c).combine_chunks() for c in SEGMENT]
    return pa.RecordBatch.from_arrays([*(c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns), a, b], names=[*SEGMENT, "a", "b"])


def _counted_windows(strings: DataFrame, window: int) -> DataFrame:
    """The same for anchors with very many segments: their windows are counted
    by two hashes, whichever task they are in."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column("content")[i].as_py(), np.uint8)
                n = len(data) - window + 1
                up, down = _powers(len(data) + 1)
                hashes = []
                for table in (_BYTE, mix(_BYTE)):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * up[: len(data)], dtype=np.uint64)])
                    hashes.append(mix((total[window:] - total[:-window]) * down[:n]).view(np.int64))
                own = [pa.array([batch.column(c)[i].as_py()] * n, batch.column(c).type) for c in [*SEGMENT, "n"]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(hashes[0]), pa.array(hashes[1]), pa.array(np.arange(n, dtype=np.int32))], names=[*SEGMENT, "n", "h1", "h2", "at"])

    rows = written(strings.select(*SEGMENT, "n", "content").mapInArrow(run, f"{_SEGMENT}, n long, h1 long, h2 long, at int"), "windows")
    again = written(rows.groupBy("h1", "h2").agg(F.sum("n").alias("total")).filter("total > 1").select("h1", "h2"), "again")
    hit = rows.join(again, ["h1", "h2"]).groupBy(*SEGMENT).agg(F.array_sort(F.collect_list("at")).alias("a"))
    return hit.select(*SEGMENT, "a", F.transform("a", lambda x: x + window).alias("b"))


# ------------------------------------------------------------------ operator


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, key2, spans) for rows of ``docs`` (key, key2, text) with repeated
    bytes; spans may overlap and are not sorted."""
    repeated = written(_anchor_counts(docs, window), "anchors")
    found = written(_occurrences(docs, Filter(repeated, repeated.count()), window), "occurrences")
    stats = found.groupBy(*SEGMENT).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "key2", "start")).alias("place"))
    distinct = written(stats, "segments")
    groups = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("strings"), F.min("n").alias("least"))
    unsettled = written(groups.filter("strings > 1 and least = 1").select("anchor", "strings"), "unsettled")
    compare = written(distinct.join(unsettled, "anchor").select(*SEGMENT, "n", "strings", "place.*"), "compare")

    whole = distinct.filter("n > 1").select(
        *SEGMENT, F.array(F.lit(0)).alias("a"), F.array(F.col("windows") + F.lit(window - 1)).alias("b")
    )
    contents = _contents(docs, Filter(_place_hashes(compare), compare.count()), window)
    strings = written(
        contents.join(compare, [*SEGMENT, "key", "key2", "start"]).dropDuplicates(SEGMENT).select(*SEGMENT, "n", "strings", "content"), "strings"
    )
    few = _compared(strings.filter(F.col("strings") <= MOST_STRINGS), window)
    many = _counted_windows(strings.filter(F.col("strings") > MOST_STRINGS), window)
    single = strings.filter("n = 1").select(*SEGMENT)
    partly = few.unionByName(many).filter(F.size("a") > 0).join(single, SEGMENT, "left_semi")
    verdict = written(whole.unionByName(partly), "verdict")
    span = F.transform(F.arrays_zip("a", "b"), lambda s: F.struct((F.col("start") + s.a).alias("a"), (F.col("start") + s.b).alias("b")))
    placed = found.join(verdict, SEGMENT).select("key", "key2", F.explode(span).alias("span"))
    return written(placed.groupBy("key", "key2").agg(F.collect_set("span").alias("spans")), "spans")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        "*", text.alias("__text"), F.xxhash64(F.col(id_col), text).alias("__key"), F.xxhash64(F.lit(2), F.col(id_col), text).alias("__key2")
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """A row for each row of ``docs``: id, n_bytes, the removed spans (array of
    a, b, in order, maximal) and kept (the remaining bytes).

    Null texts count as empty. Rows that repeat id and text are places of their
    own, so each removes the other. An empty table gives no rows. Other columns
    are not read.
    """
    keyed = _keyed(docs.select(F.col(id_col), F.col(text_col)), id_col, text_col).select(
        F.col(id_col).alias("id"), F.col("__text").alias("text"), F.col("__key").alias("key"), F.col("__key2").alias("key2")
    )
    spans = repeated_spans(keyed.drop("id"), window)

    def run(batches):
        for batch in slices(batches, "text"):
            n, removed, kept = [], [], []
            for blob, own in zip(_blobs(batch), batch.column("spans").to_pylist()):
                cut = merged([(s["a"], s["b"]) for s in own or ()])
                edges = [0, *(x for s in cut for x in s), len(blob)]
                n.append(len(blob))
                removed.append([{"a": a, "b": b} for a, b in cut])
                kept.append(b"".join(blob[a:b] for a, b in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())], names=["id", "n_bytes", "removed", "kept"]
            )

    more = StructType.fromDDL("n_bytes long, removed array<struct<a:long,b:long>>, kept binary").fields
    schema = StructType([StructField("id", keyed.schema["id"].dataType), *more])
    joined = keyed.join(spans, ["key", "key2"], "left").select("id", "text", "spans")
    return joined.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes",
        F.coalesce(F.aggregate("removed", F.lit(0).cast("long"), lambda t, s: t + s.b - s.a), F.lit(0)).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
