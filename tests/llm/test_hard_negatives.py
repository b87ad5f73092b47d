from __future__ import annotations

import math
import random

import numpy as np
import pytest

from blotter.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, id string, score string, block int, anchor_id int, extra string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "i", "s", 3, 4, "e") for r in rows], SCHEMA)


def brute(rows, is_anchor):
    kept: dict = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [min(max(math.floor(256 * x) if math.isfinite(256 * x) else (2**63 if x > 0 else -(2**63)), -(2**63)), 2**63 - 1) for x in v]
        kept[i] = min(kept.get(i, (label, whole)), (label, whole))
    out = []
    for a in filter(is_anchor, kept):
        label, va = kept[a]
        score = {i: min(max(sum(x * y for x, y in zip(va, v)), -(2**63)), 2**63 - 1) for i, (_, v) in kept.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if kept[i][0] == label][: H.POSITIVES]:
            found = [i for i in order if kept[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(found[: H.NEGATIVES])]
    return sorted(out)


def clustered(seed, n, dim=8, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dim))
    label = rng.integers(0, labels, n)
    return [(i, (centre[k] + rng.normal(size=dim)).round(2).tolist(), int(k)) for i, k in enumerate(label.tolist())]


def mined(spark, rows, anchors=lambda i: i % 10 == 0, **more):
    df = H.mine(table(spark, rows), anchors, **more)
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("seed, block_rows", [(1, H.BLOCK_ROWS), (2, 7)])
def test_brute_force(spark, seed, block_rows):
    rows = clustered(seed, 400)
    assert mined(spark, rows, block_rows=block_rows) == brute(rows, lambda i: i % 10 == 0) != []


def test_edges(spark):
    """Nulls, components that are not finite, ties, repeated rows, an id twice,
    vectors without length or components, of another length, very large ones."""
    rng = random.Random(3)
    rows = clustered(4, 120)
    rows += [(10 * k, [0.5] * 8, 1) for k in range(200, 215)] + [(10 * k + 1, [0.5] * 8, k % 2) for k in range(200, 240)]
    rows += rows[:20] + [(5, [1.0] * 8, 0), (None, [1.0] * 8, 1), (900, None, 1), (910, [1.0] * 8, None), (920, [1.0, None], 1)]
    rows += [(930, [math.nan], 1), (940, [math.inf], 2), (950, [], 1), (960, [0.0] * 8, 2), (970, [2.0, 1.0], 1), (980, [2.0] * 11, 2), (-10, [0.3] * 8, 1)]
    rng.shuffle(rows)
    assert mined(spark, rows, block_rows=16) == brute(rows, lambda i: i % 10 == 0)
    big = [(i, [rng.choice([1e9, 3e15, 1e18, 1e300, -1e17]) * rng.random(), 1.0, 2e8], i % 2) for i in range(60)]
    assert mined(spark, big) == brute(big, lambda i: i % 10 == 0)
    assert mined(spark, []) == [] and mined(spark, [(10, [1.0], 1)]) == []


def test_one_vector_with_a_third_of_all_rows(spark):
    rows = clustered(5, 600)
    rows = [(i, [0.25, 0.5, 0.75, 1.0] * 2 if i % 3 == 0 else v, k) for i, v, k in rows]
    assert mined(spark, rows, block_rows=50) == brute(rows, lambda i: i % 10 == 0)
    blocks = H.in_blocks(H.with_angles(H.usable(table(spark, rows), "vec_id", "embedding", "label")), 50)
    assert max(r["count"] for r in blocks.groupBy("block").count().collect()) < 100


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(4, 64)) * 300
    vec = (np.repeat(centre, 100, 0) + rng.normal(size=(400, 64)) * 60).astype(np.int64)
    size, angle = H.angles_to(vec, H.directions(vec))
    least, most = H.score_bounds(size, angle, size, angle)
    exact = vec @ vec.T
    assert (least <= exact).all() and (exact <= most).all()
    floor = int(0.8 * np.diag(exact).mean())
    assert (most >= floor).mean() < 0.5  # pairs of other clusters are not scored


def test_query_matches_sql(spark):
    import duckdb

    from tests.conftest import SMOKE_DIR

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMOKE_DIR}/embeddings.parquet')")
    cols = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    want = con.execute(f"SELECT {cols} FROM ({H.SQL}) ORDER BY ALL").fetchall()
    assert sorted(tuple(r) for r in H.query(spark, SMOKE_DIR).select(*cols.split(", ")).collect()) == want
