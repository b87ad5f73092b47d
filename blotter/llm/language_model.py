"""Word bigram model with deleted interpolation.

log10 P(w | v) mixes the maximum-likelihood estimates of the bigram and of the
word with a uniform share. The mixture weights depend on the bucket of the
context's count (powers of two) and are learned by expectation-maximisation:
the counts of one part of the training rows give the estimates, the tokens of
the rest are the held-out counts. The final estimates use all training rows.

Rows are dealt into blocks of about ``BLOCK_BYTES`` of text. A block sends each
of its distinct n-grams once, sorted by hash and packed, to the part that holds
that range of hashes; the part sums them over all blocks and returns the counts
in the order in which they came. A frequent n-gram is thus one entry a block,
no n-gram is dropped, and the counts grow with the corpus.

A block sends to at most ``FAN`` ranges. Beyond so many parts the way has several
levels: a node merges one range of ``FAN`` senders, which is about what a block
holds, and sends to ``FAN`` finer ranges; the totals come back the same way. The
rows that are sent thus grow with the corpus (times the levels, their logarithm),
not with blocks times parts, and no group grows.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import Words, documents, joined_hash, written

FOLDS = 5
#: Remainder of the rows that are not learned from, and of those held out for the weights.
TEST_FOLD, WEIGHT_FOLD = 1, 4
COUNTED, WEIGHED, TEST = 0, 1, 2
BLOCK_BYTES = 4_000_000
PART_BYTES = 8_000_000
#: Ranges that a block or node sends to, and senders that a node merges.
FAN = 512
#: One for each power of two that a long count may reach.
BUCKETS = 64
#: Expectation-maximisation ends when a round raises the log-likelihood by no
#: more than this share of it, or after so many rounds.
GAIN, ROUNDS = 1e-6, 60
#: Probabilities are rounded to so many steps an octave for the weights alone.
GRID = 16
_NEVER = -(10**6)
#: The least weight of the uniform share.
FLOOR = 1e-6
#: Texts are split into words by so many at once.
_AT_ONCE = 500_000
START, END = np.uint64(0x5353), np.uint64(0x4545)


def zstd() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def pack(values: np.ndarray) -> bytes:
    """Byte planes, compressed: high bytes are alike."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (zstd().compress(planes, asbytes=True) if planes else b"")


def unpack(blob: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(zstd().decompress(blob[8:], size, asbytes=True) if size else b"", np.uint8)
    planes = planes.reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def pack_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text, role, block) as (block, role, rows): those of a
    block that a task has read at once, compressed. Texts are shuffled twice,
    and so take less than half the room."""

    def run(batches):
        for batch in batches:
            block = batch.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            edges = [0, *(np.flatnonzero(np.diff(block[order])) + 1).tolist(), len(block)]
            table = pa.Table.from_batches([batch])
            out = []
            for a, b in zip(edges, edges[1:]):
                if a < b:
                    part = table.take(pa.array(order[a:b]))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression=zstd())) as writer:
                        writer.write_table(part.select(["id", "text", "role", "block"]))
                    out.append((int(block[order[a]]), int(part.column("role")[0].as_py()), sink.getvalue().to_pybytes()))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "role", "rows"])

    return rows.select("id", "text", "role", "block").mapInArrow(run, "block long, role int, rows binary")


def unpack_rows(blobs: pd.Series) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs])


class Tokens:
    """The tokens of some texts: their words and, for each text, one end.
    ``keys`` are the distinct n-grams; word, context and pair index them."""

    def __init__(self, texts: list[str]):
        hashes, sizes, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        while at < len(texts):
            size, upto = 0, at
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= _AT_ONCE):
                size += len(texts[upto])
                upto += 1
            words = Words(texts[at:upto], lower=True)
            hashes.append(words.hash)
            sizes.append(np.diff(words.first))
            at = upto
        n = np.concatenate(sizes) + 1
        self.doc = np.repeat(np.arange(len(texts)), n)
        last = np.cumsum(n) - 1
        token = np.full(int(n.sum()), END)
        inside = np.ones(len(token), bool)
        inside[last] = False
        token[inside] = np.concatenate(hashes)
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[last - n + 1] = START
        one, two = np.uint64(1), np.uint64(0)
        word = joined_hash([token]) | one
        context = np.where(before == START, START & ~one, joined_hash([before]) | one)
        pair = joined_hash([before, token]) & ~one | two
        self.keys, at = np.unique(np.concatenate([word, context, pair]), return_inverse=True)
        self.word, self.context, self.pair = np.split(at, 3)

    def counts(self) -> np.ndarray:
        """Of each key: tokens of a word, pairs, and texts for the start."""
        out = np.bincount(np.concatenate([self.word, self.pair]), minlength=len(self.keys))
        start = np.flatnonzero(self.keys == (START & ~np.uint64(1)))
        out[start] = self.doc[-1] + 1 if len(self.doc) else 0
        return out.astype(np.int64)


def _parts(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key; ascends with the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


_SENT = "node long, sender long, part long, keys binary, counted binary, weighed binary"
_RETURNED = "sender long, part long, counted binary, weighed binary, n_counted long, n_weighed long, n_distinct long"


class Levels:
    """Where packed n-grams go. At level k (from 0) there are ``parts[k]`` ranges
    of hashes, each inside one of the level before, and ``groups[k]`` groups of
    senders; a node is a range and a group."""

    def __init__(self, size: int, blocks: int):
        want = max(1, ceil(size / PART_BYTES))
        self.parts = [min(want, FAN)]
        while self.parts[-1] < want:
            self.parts.append(self.parts[-1] * min(FAN, ceil(want / self.parts[-1])))
        self.groups = [max(1, ceil(blocks / FAN ** (k + 1))) for k in range(len(self.parts))]
        self.groups[-1] = 1

    def send(self, level: int, group: int, sender: int, keys: np.ndarray, counts: list[np.ndarray]) -> pd.DataFrame:
        """Rows of ``_SENT`` to the nodes of a level, for sorted keys."""
        part = _parts(keys, self.parts[level])
        edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]) if len(part) else np.zeros(1, np.int64)
        rows = []
        for a, b in zip(edges, edges[1:]):
            node = int(part[a]) * self.groups[level] + group // FAN if level < len(self.parts) - 1 else int(part[a])
            rows.append((node, sender, int(part[a]), pack(np.diff(keys[a:b], prepend=np.uint64(0))), *(pack(c[a:b]) for c in counts)))
        return pd.DataFrame(rows, columns=[f.split()[0] for f in _SENT.split(", ")])


def _ngrams(levels: Levels):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        tokens = Tokens(unpack_rows(group["rows"]).column("text").to_pylist())
        block, role, count = int(group["block"].iloc[0]), group["role"].iloc[0], tokens.counts()
        return levels.send(0, block, block, tokens.keys, [count * (role == r) for r in (COUNTED, WEIGHED)])

    return run


class Merged:
    """The sent rows that came to a node: distinct keys, and where each sender's are among them."""

    def __init__(self, group: pd.DataFrame):
        keys = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in group["keys"]]
        self.distinct, self.at = np.unique(np.concatenate(keys), return_inverse=True)
        self.edges = np.cumsum([0, *map(len, keys)])
        self.sender, self.part = group["sender"].to_numpy(), group["part"].to_numpy()

    def total(self, packed: pd.Series) -> np.ndarray:
        counts = np.concatenate([unpack(c, np.int64) for c in packed])
        return np.bincount(self.at, weights=counts, minlength=len(self.distinct)).astype(np.int64)

    def returned(self, totals: list[np.ndarray]) -> pd.DataFrame:
        """Each sender's part of the totals, in its own order."""
        out = pd.DataFrame({"sender": self.sender, "part": self.part})
        for name, total in zip(("counted", "weighed"), totals):
            out[name] = [pack(total[self.at[a:b]]) for a, b in zip(self.edges, self.edges[1:])]
        return out.assign(n_counted=0, n_weighed=0, n_distinct=0)


def _passed_on(levels: Levels, level: int):
    """A node of ``level`` sends its merged counts to the next."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        merged, node = Merged(group), int(group["node"].iloc[0])
        totals = [merged.total(group[c]) for c in ("counted", "weighed")]
        return levels.send(level + 1, node % levels.groups[level], node, merged.distinct, totals)

    return run


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    """The counts over all blocks, for each sender in its own order."""
    merged = Merged(group)
    totals = [merged.total(group[c]) for c in ("counted", "weighed")]
    is_word = (merged.distinct & np.uint64(1)).astype(bool)
    out = merged.returned(totals)
    out.loc[0, "n_counted"] = int(totals[0][is_word].sum())
    out.loc[0, "n_weighed"] = int(totals[1][is_word].sum())
    out.loc[0, "n_distinct"] = int(((totals[0] + totals[1])[is_word] > 0).sum())
    return out


def _handed_down(sent: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """The totals that came back to a node, for each of its senders."""
    merged = Merged(sent)
    counts = counts.sort_values("part")
    return merged.returned([np.concatenate([unpack(c, np.int64) for c in counts[name]]) for name in ("counted", "weighed")])


def corpus_counts(dealt: DataFrame, levels: Levels) -> tuple[DataFrame, tuple[int, int, int]]:
    """(block, part, counted, weighed) for each block, and the numbers of counted
    tokens, weighed tokens and distinct words."""
    sent = [dealt.groupBy("block").applyInPandas(_ngrams(levels), _SENT)]
    for level in range(len(levels.parts) - 1):
        sent[-1] = written(sent[-1], "sent")  # merged now, and once more on the way back
        sent.append(sent[-1].groupBy("node").applyInPandas(_passed_on(levels, level), _SENT))
    returned = written(sent[-1].groupBy("node").applyInPandas(_summed, _RETURNED), "counts")
    totals = returned.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_counted", "n_weighed", "n_distinct")]).first()
    for there in sent[-2::-1]:
        back = returned.select(F.col("sender").alias("to"), "part", "counted", "weighed")
        returned = written(there.groupBy("node").cogroup(back.groupBy("to")).applyInPandas(_handed_down, _RETURNED), "counts")
    return returned.select(F.col("sender").alias("block"), "part", "counted", "weighed"), tuple(map(int, totals))


def _of_block(tokens: Tokens, counts: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The totals of a block's keys, which went to the parts in their order."""
    counts = counts.sort_values("part")
    out = tuple(np.concatenate([unpack(c, np.int64) for c in counts[name]]) for name in ("counted", "weighed"))
    if len(out[0]) != len(tokens.keys):
        raise ValueError("the counts of a block don't fit its n-grams")
    return out


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(float))[1], BUCKETS - 1)


def _ratio(a: np.ndarray, b) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.broadcast_to(np.asarray(b) > 0, a.shape))


def _cells(n_counted: int):
    """Held-out tokens by bucket and rounded estimates."""

    def run(docs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        tokens = Tokens(unpack_rows(docs["rows"]).column("text").to_pylist())
        c, _ = _of_block(tokens, counts)
        context = c[tokens.context]
        grid = []
        for p in (_ratio(c[tokens.word], n_counted), _ratio(c[tokens.pair], context)):
            grid.append(np.where(p > 0, np.round(np.log2(np.maximum(p, 1e-300)) * GRID), _NEVER).astype(np.int64))
        cells = pd.DataFrame({"bucket": bucket_of(context).astype(np.int64), "one": grid[0], "two": grid[1]})
        return cells.groupby(["bucket", "one", "two"]).size().reset_index(name="n")

    return run


def learn_weights(cells: DataFrame, n_distinct: int) -> np.ndarray:
    """(buckets, 3) weights of pair, word and uniform share. Each round sums
    the posteriors by bucket in Spark; a bucket without tokens shares those of all."""
    value = lambda c: F.when(F.col(c) > _NEVER, F.pow(F.lit(2.0), F.col(c) / GRID)).otherwise(0.0)
    uniform = 1.0 / (n_distinct + 1)
    data = written(cells.groupBy("bucket", "one", "two").agg(F.sum("n").alias("n")), "cells").select(
        "bucket", "n", value("two").alias("p0"), value("one").alias("p1"), F.lit(uniform).alias("p2")
    )
    weights, before = np.full((BUCKETS, 3), 1 / 3), None
    for _ in range(ROUNDS):
        table = F.array(*[F.array(*map(F.lit, map(float, row))) for row in weights])
        mine = F.get(table, F.col("bucket").cast("int"))
        terms = [F.get(mine, k) * F.col(f"p{k}") for k in range(3)]
        whole = terms[0] + terms[1] + terms[2]
        likelihood = F.sum(F.col("n") * F.log(whole)).alias("likelihood")
        sums = data.groupBy("bucket").agg(*[F.sum(F.col("n") * t / whole).alias(f"s{k}") for k, t in enumerate(terms)], likelihood).collect()
        now = sum(r.likelihood for r in sums)
        if before is not None and now - before <= GAIN * abs(before):
            break
        before, total = now, np.zeros((BUCKETS, 3))
        for r in sums:
            total[r.bucket] = [r.s0, r.s1, r.s2]
        seen = total.sum(axis=1) > 0
        total[~seen] = total.sum(axis=0) if seen.any() else 1.0
        weights = np.maximum(total / total.sum(axis=1, keepdims=True), FLOOR)
        weights /= weights.sum(axis=1, keepdims=True)
    return weights


def _scores(weights: np.ndarray, n: int, distinct: int):
    def run(docs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        table = unpack_rows(docs["rows"])
        tokens = Tokens(table.column("text").to_pylist())
        c = sum(_of_block(tokens, counts))
        word, context = c[tokens.word], c[tokens.context]
        mix = weights[bucket_of(context)]
        p = mix[:, 0] * _ratio(c[tokens.pair], context) + mix[:, 1] * _ratio(word, n) + mix[:, 2] / (distinct + 1)
        base = np.log10((word + 0.5) / (n + 0.5 * (distinct + 1)))
        rows = table.num_rows
        sums = lambda x=None: np.bincount(tokens.doc, weights=x, minlength=rows)
        return pd.DataFrame({
            "id": pd.Series(table.column("id").to_pylist(), dtype=object), "held_out": bool(docs["role"].iloc[0] == TEST), "n_tokens": sums().astype(np.int64),
            "n_known": sums(word > 0).astype(np.int64), "train_tokens": n,
            "base_score": sums(base), "score": sums(np.log10(p)),
        })

    return run


def role_of(id_col: Column) -> Column:
    """Null ids count as the empty string."""
    fold = F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % FOLDS
    return F.when(fold == TEST_FOLD, TEST).when(fold == WEIGHT_FOLD, WEIGHED).otherwise(COUNTED)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: id, held_out, n_tokens, n_known,
    train_tokens, base_score (add one half on words alone) and score.

    Null texts count as empty: one end token. Repeated rows are learned from
    as often as they occur and get equal scores. An empty table gives no rows;
    without training rows only the uniform share is left. Other columns are
    not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    picked = docs.select(F.col(id_col).alias("id"), text.alias("text"), role_of(F.col(id_col)).alias("role"))
    size = docs.agg(F.sum(F.octet_length(text) + 1)).first()[0] or 0
    blocks = {COUNTED: 3, WEIGHED: 1, TEST: 1}
    number = {r: max(1, ceil(size * share / FOLDS / BLOCK_BYTES)) for r, share in blocks.items()}
    of_role = F.when(F.col("role") == TEST, number[TEST]).when(F.col("role") == WEIGHED, number[WEIGHED]).otherwise(number[COUNTED])
    # by a number of the row too, so that neither null ids nor rows that repeat with their id fill one block
    block = F.pmod(F.xxhash64("id", "text", "row"), of_role.cast("long")) * 3 + F.col("role")
    numbered = picked.withColumn("row", F.monotonically_increasing_id())
    dealt = written(pack_rows(numbered.withColumn("block", block)), "dealt")

    returned, (n_counted, n_weighed, n_distinct) = corpus_counts(dealt, Levels(size, 3 * max(number.values())))

    held = dealt.filter(F.col("role") == WEIGHED).groupBy("block").cogroup(
        returned.filter(F.col("block") % 3 == WEIGHED).groupBy("block")
    )
    cells = held.applyInPandas(_cells(n_counted), "bucket long, one long, two long, n long")
    weights = learn_weights(cells, n_distinct)

    fields = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    from pyspark.sql.types import StructField, StructType

    schema = StructType([StructField("id", picked.schema["id"].dataType), *StructType.fromDDL(fields).fields])
    scored = dealt.groupBy("block").cogroup(returned.groupBy("block")).applyInPandas(
        _scores(weights, n_counted + n_weighed, n_distinct), schema
    )
    return scored.withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))
