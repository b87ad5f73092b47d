"""Hard negatives by inner product, with angular triangle filtering.

Every vector keeps its length and its angles to some reference directions. For
two vectors, the angles to one direction bound the angle between them from both
sides (the triangle inequality on the sphere); the tightest bounds over all the
directions give an interval of the cosine, and times both lengths, widened
against rounding, one of the score. Only pairs whose interval meets the window
that is asked for are scored, in integers.

Rows stand in blocks of bounded size, by label and nearest direction. Each anchor
goes to the blocks whose own interval (from the ranges of their angles and
lengths) meets its windows; a task holds one block, and its anchors stream past.
So neither a label nor a vector that many rows share fills a task, nothing is
broadcast but a few counts, and the driver sees a bounded sample alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import written

POSITIVES, NEGATIVES = 5, 10
#: Bounds of a negative's score, in hundredths of the positive's.
LEAST, MOST = 30, 90
#: Reference directions, and the rows (of the least hashes) that they are chosen from.
REFERENCES, SAMPLE_ROWS = 16, 1024
BLOCK_ROWS = 1 << 15
_LABEL_BUCKETS = 16
#: Slack of angles and, relative, of scores; far above rounding error.
_ANGLE, _SCORE = 1e-6, 1e-9
#: Pairs of an anchor and a row that are bounded at once.
_AT_ONCE = 1 << 20


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vec) of the rows that take part, components as whole numbers
    of 1/256, saturating at 64 bits. Of rows that share an id, the one with the
    smallest label and vector."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    good = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False))
    vec = F.transform(x, lambda c: F.floor(F.lit(256.0) * c.cast("double")).cast("long"))
    picked = vectors.filter(good).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vec.alias("vec"))
    return picked.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")


# ------------------------------------------------------------------ geometry


def matrix(vectors: list, dim: int = 0) -> np.ndarray:
    """Rows of integers; shorter vectors end in zeros."""
    dim = max([dim, *map(len, vectors)])
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def directions(sample: np.ndarray, n: int = REFERENCES) -> np.ndarray:
    """``n`` unit vectors, each a sampled one far from those before it; axes of
    the space where the sample has too few directions."""
    x = sample.astype(np.float64)
    size = np.linalg.norm(x, axis=1)
    x = x[size > 0] / size[size > 0, None]
    chosen: list[np.ndarray] = []
    nearest = np.full(len(x), -2.0)
    while len(x) and len(chosen) < n:
        k = int(np.argmin(nearest)) if chosen else 0
        if chosen and nearest[k] > 1 - 1e-12:
            break
        chosen.append(x[k])
        nearest = np.maximum(nearest, x @ x[k])
    dim = max(sample.shape[1], 1)
    axes = [np.eye(dim)[k % dim] for k in range(n - len(chosen))]
    return np.array([*chosen, *axes])


def angles_to(vec: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and angles; a vector without length is at a right angle to all."""
    x = vec.astype(np.float64)
    dim = max(x.shape[1], refs.shape[1])
    x, r = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) for m in (x, refs))
    size = np.linalg.norm(x, axis=1)
    unit = x / np.where(size > 0, size, 1.0)[:, None]
    return size, np.arccos(np.clip(unit @ r.T, -1, 1))


def score_bounds(size_a, angle_a, size_b, angle_b) -> tuple[np.ndarray, np.ndarray]:
    """Least and most score for each of the anchors (rows) and vectors (columns)."""
    near = np.zeros((len(size_a), len(size_b)))
    far = np.full(near.shape, np.pi)
    for k in range(angle_a.shape[1]):
        a, b = angle_a[:, k, None], angle_b[None, :, k]
        np.maximum(near, np.abs(a - b), out=near)
        total = a + b
        np.minimum(far, np.minimum(total, 2 * np.pi - total), out=far)
    size = size_a[:, None] * size_b[None, :]
    slack = size * _SCORE + 1e-3
    most = size * np.cos(np.maximum(near - _ANGLE, 0)) + slack
    least = size * np.cos(np.minimum(far + _ANGLE, np.pi)) - slack
    return np.floor(least), np.ceil(most)


def scores(vec: np.ndarray, one: np.ndarray, size: float) -> np.ndarray:
    """Integer inner products, saturating at 64 bits; ``size`` bounds them."""
    dim = min(vec.shape[1], len(one))
    if size < 2.0**62:
        return vec[:, :dim] @ one[:dim]
    exact = vec[:, :dim].astype(object) @ one[:dim].astype(object)
    return np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in exact], np.int64)


def first(found: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, of equal ones those of smaller ids first."""
    # the complement falls as the score rises, without leaving 64 bits
    some = np.arange(len(found))
    if len(found) > 4 * n:
        some = np.flatnonzero(found >= np.partition(found, len(found) - n)[len(found) - n])
    return some[np.lexsort((ids[some], ~found[some]))[:n]]


def window(positive: int) -> tuple[int, int]:
    """Least and most score of a negative of a positive with this score."""
    return -(-LEAST * positive // 100), MOST * positive // 100


class Block:
    """Rows of a block: ``ids``, ``labels``, ``size``, ``angle``, ``vec``."""

    def __init__(self, batches: list):
        import pyarrow as pa

        rows = pa.Table.from_batches(batches).combine_chunks()
        self.ids, self.labels, self.size = (rows.column(c).to_numpy() for c in ("id", "label", "size"))
        self.angle = np.array(rows.column("angles").combine_chunks().flatten()).reshape(len(self.ids), -1)
        self.vec = matrix(rows.column("vec").to_pylist())
        #: The 64-bit range may be left beyond this bound of the scores.
        self.largest = float(self.size.max())

    def positives(self, anchors: Block) -> Iterator[tuple]:
        """(anchor, id, score) of the first rows with the anchor's label."""
        least, most = score_bounds(anchors.size, anchors.angle, self.size, self.angle)
        other = (anchors.labels[:, None] == self.labels) & (anchors.ids[:, None] != self.ids)
        for i in np.flatnonzero(other.any(1)):
            at = np.flatnonzero(other[i])
            if len(at) > POSITIVES:
                floor = np.partition(least[i, at], len(at) - POSITIVES)[len(at) - POSITIVES]
                at = at[most[i, at] >= floor]
            found = scores(self.vec[at], anchors.vec[i], self.largest * anchors.size[i])
            for k in first(found, self.ids[at], POSITIVES):
                yield anchors.ids[i], self.ids[at[k]], found[k]

    def negatives(self, anchors: Block, asked: list[list[dict]]) -> Iterator[tuple]:
        """(anchor, positive, its score, id, score) of the first rows in each window."""
        least, most = score_bounds(anchors.size, anchors.angle, self.size, self.angle)
        other = anchors.labels[:, None] != self.labels
        for i, positives in enumerate(asked):
            low, high = least[i], most[i]
            wanted = np.zeros(len(self.ids), bool)
            windows = [(p["id"], p["score"], *window(p["score"])) for p in positives]
            for _, _, floor, top in windows:
                if floor > top:
                    continue
                inside = low[other[i] & (low >= floor) & (high <= top)]
                # rows that are surely inside: the tenth of them is a floor for the rest
                bar = np.partition(inside, len(inside) - NEGATIVES)[len(inside) - NEGATIVES] if len(inside) >= NEGATIVES else float(floor)
                wanted |= (high >= bar - abs(bar) * _SCORE) & (low <= top + abs(top) * _SCORE)
            at = np.flatnonzero(wanted & other[i])
            if not len(at):
                continue
            found, ids = scores(self.vec[at], anchors.vec[i], self.largest * anchors.size[i]), self.ids[at]
            for positive, score, floor, top in windows:
                some = np.flatnonzero((found >= floor) & (found <= top))
                for k in some[first(found[some], ids[some], NEGATIVES)]:
                    yield anchors.ids[i], positive, score, ids[k], found[k]


# ------------------------------------------------------------------ Spark


_ROW = "id long, label long, size double, angles array<double>, cell int, vec array<long>"
_ASK = "block long, kind int, id long, label long, size double, angles array<double>, vec array<long>, asked array<struct<id: long, score: long>>"


def with_angles(rows: DataFrame) -> DataFrame:
    """``rows`` (id, label, vec) with length, angles and the nearest direction, written."""
    sample = [r.vec for r in rows.select("vec", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(SAMPLE_ROWS).collect()]
    refs = directions(matrix(sample, 1)) if sample else np.eye(REFERENCES)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                size, angle = angles_to(matrix(batch.column("vec").to_pylist(), 1), refs)
                starts = pa.array(np.arange(0, angle.size + 1, angle.shape[1], dtype=np.int32))
                columns = [
                    batch.column("id"), batch.column("label"), pa.array(size), pa.ListArray.from_arrays(starts, pa.array(angle.ravel())),
                    pa.array(angle.argmin(1).astype(np.int32)), batch.column("vec"),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "size", "angles", "cell", "vec"])

    return written(rows.mapInArrow(run, _ROW), "angles")


def in_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """``rows`` with ``bucket`` (of the label) and ``block``: the rows of a bucket
    and direction, in as many parts as keep one to about ``block_rows``."""
    bucket = F.pmod(F.xxhash64("label"), F.lit(_LABEL_BUCKETS))
    rows = rows.withColumn("bucket", bucket)
    count = rows.groupBy("bucket", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    # at most _LABEL_BUCKETS x REFERENCES counts
    dealt = rows.join(F.broadcast(count), ["bucket", "cell"])
    part = F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts"))
    return dealt.withColumn("block", F.expr(f"(bucket * {REFERENCES} + cell) * {2**40}") + part).drop("parts")


def _streamed(members: DataFrame, asks: DataFrame, schema: str, answer) -> DataFrame:
    """Each block's members, then its anchors, in a task; ``answer(block, anchors,
    asked)`` yields result rows for some anchors at once."""
    none = F.lit(None).cast("array<struct<id: long, score: long>>")
    columns = ["id", "label", "size", "angles", "vec"]
    both = members.select("block", F.lit(0).alias("kind"), *columns, none.alias("asked")).unionByName(
        asks.select("block", F.lit(1).alias("kind"), *columns, *(["asked"] if "asked" in asks.columns else [none.alias("asked")]))
    )
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(batches):
        import pyarrow as pa

        held, of, block = [], None, None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("block", "kind")], 1)
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for a, b in zip(edges, edges[1:]) if len(key) else ():
                part, (at, kind) = batch.slice(a, b - a), key[a].tolist()
                if kind == 0:
                    held = [*held, part] if at == of else [part]
                    of, block = at, None
                    continue
                if at != of:
                    continue  # no such members
                block = block or Block(held)
                step = max(1, _AT_ONCE // len(block.ids))
                for i in range(0, len(part), step):
                    some = part.slice(i, step)
                    out = list(answer(block, Block([some]), some.column("asked").to_pylist()))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*out)], names=names)

    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(run, schema)


def mine(
    vectors: DataFrame, anchors, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """For each anchor (rows where the condition ``anchors`` on ``id`` holds) and
    each of its first positives, the first negatives of the window: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    Rows without an id, label or vector, or with a component that is null or
    not finite, take no part; of rows that share an id one does (see
    ``usable``). Equal scores go by the smaller id. A shorter vector ends in
    zeros, one without length scores zero. Scores saturate at 64 bits. A
    positive whose window is empty or holds no row gives no rows; so does an
    empty table. Other columns are not read.
    """
    rows = written(in_blocks(with_angles(written(usable(vectors, id_col, vector_col, label_col), "vectors")), block_rows), "blocks")
    ranges = [f"{f}(angles[{k}]) AS {n}{k}" for k in range(REFERENCES) for f, n in (("min", "low"), ("max", "high"))]
    blocks = written(rows.groupBy("block", "bucket").agg(*map(F.expr, ranges), F.max("size").alias("largest")), "ranges")
    asking = rows.filter(anchors(F.col("id"))).select("id", "label", "size", "angles", "vec", "bucket")

    def best(df: DataFrame, by: list[str], n: int, score: str, other: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), F.asc(other)))
        return df.withColumn("rank", place).filter(F.col("rank") <= n)

    found = _streamed(
        rows, asking.join(blocks.select("block", "bucket"), "bucket"), "anchor long, positive long, score long", lambda b, a, _: b.positives(a)
    )
    found = written(best(found, ["anchor"], POSITIVES, "score", "positive"), "positives")
    asked = found.groupBy("anchor").agg(
        F.collect_list(F.struct(F.col("positive").alias("id"), "score")).alias("asked"), F.min("score").alias("s0"), F.max("score").alias("s1")
    )
    # The least angle of an anchor to any row of a block bounds the scores there.
    gap = ", ".join(f"low{k} - angles[{k}], angles[{k}] - high{k}" for k in range(REFERENCES))
    most = f"size * largest * (cos(greatest(0D, greatest({gap}) - {_ANGLE!r}D)) + {_SCORE!r}D) + 1D"
    asks = asking.join(asked, asking["id"] == asked["anchor"]).filter("s1 >= 0")
    asks = asks.drop("bucket").join(blocks, F.expr(f"greatest(s0, 0) * {LEAST / 100!r}D - 1D <= {most}"))
    pairs = _streamed(
        rows, asks, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", lambda b, a, x: b.negatives(a, x)
    )
    ranked = best(pairs, ["anchor_id", "positive_id"], NEGATIVES, "negative_score", "negative_id")
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh id has another label, every hundredth is an anchor."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", label), lambda i: i % 100 == 0)


SQL = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS s
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) AS k FROM pairs WHERE same) t WHERE k <= {POSITIVES}
),
ranked AS (
    SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.s AS positive_score, n.s AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.s DESC, n.id) AS k
    FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND {LEAST} * p.s <= 100 * n.s AND 100 * n.s <= {MOST} * p.s
)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE k <= {NEGATIVES}
"""
