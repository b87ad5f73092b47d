from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest

from blotter.llm import language_model as L
from tests.conftest import SMOKE_DIR
from tests.llm.conftest import EDGES, table


def tokens(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]


def fold(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 5


def brute(rows):
    """The model in plain Python, with weights learned on unrounded estimates."""
    train = [(i, tokens(t)) for i, t in rows if fold(i) != 1]
    count = collections.Counter(w for _, ws in train for w in ws)
    n, v = sum(count.values()), len(count)

    def grams(texts):
        pair, context, word = collections.Counter(), collections.Counter(), collections.Counter()
        for ws in texts:
            for a, b in zip(["<s>", *ws], ws):
                pair[a, b] += 1
                context[a] += 1
                word[b] += 1
        return pair, context, word

    def parts(g, total, a, b):
        pair, context, word = g
        return L.bucket_of(np.array([context[a]]))[0], np.array([pair[a, b] / context[a] if context[a] else 0, word[b] / total if total else 0, 1 / (v + 1)])

    counted = grams([ws for i, ws in train if fold(i) != 4])
    held = [parts(counted, sum(counted[2].values()), a, b) for i, ws in train if fold(i) == 4 for a, b in zip(["<s>", *ws], ws)]
    weights = np.full((L.BUCKETS, 3), 1 / 3)
    for _ in range(L.ROUNDS):
        total = np.zeros_like(weights)
        for k, p in held:
            x = weights[k] * p
            total[k] += x / x.sum()
        seen = total.sum(axis=1) > 0
        total[~seen] = total.sum(axis=0) if seen.any() else 1.0
        weights = np.maximum(total / total.sum(axis=1, keepdims=True), L.FLOOR)
        weights /= weights.sum(axis=1, keepdims=True)
    final = grams([ws for _, ws in train])
    out = {}
    for i, t in rows:
        ws = tokens(t)
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        score = sum(math.log10(float(weights[k] @ p)) for k, p in (parts(final, n, a, b) for a, b in zip(["<s>", *ws], ws)))
        out[i, t or ""] = (fold(i) == 1, len(ws), sum(count[w] > 0 for w in ws), n, base, score)
    return out


def compare(rows, frame, monkeypatch=None):
    want = brute(rows)
    got = frame.collect()
    assert len(got) == len(rows)
    by_id = collections.defaultdict(list)
    for (i, _), x in want.items():
        by_id[i].append(x)
    for r in got:
        best = min(by_id[r.doc_id], key=lambda x: abs(x[4] - r.base_score))
        assert tuple(r)[1:5] == best[:4]
        assert r.base_score == pytest.approx(best[4], abs=1e-6)
        assert r.score == pytest.approx(best[5], rel=0.01, abs=0.01)  # weights from rounded estimates


def test_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_BYTES", 30_000)
    monkeypatch.setattr(L, "PART_BYTES", 40_000)
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    compare([tuple(r) for r in docs.select("doc_id", "text").collect()], L.score_texts(docs))


def test_levels_change_no_score(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    rows = lambda: sorted(tuple(r) for r in L.score_texts(docs).collect())
    monkeypatch.setattr(L, "BLOCK_BYTES", 30_000)
    want = rows()
    monkeypatch.setattr(L, "PART_BYTES", 12_000)
    monkeypatch.setattr(L, "FAN", 4)
    assert len(L.Levels(250_000, 30).parts) == 3
    for a, b in zip(want, rows()):
        assert a[:5] == b[:5] and b[5:] == pytest.approx(a[5:], rel=1e-9)


def test_sent_rows_grow_with_the_corpus():
    """At most FAN rows from a block or node, and as many nodes as blocks, whatever the size."""
    for size in (10**9, 10**12, 10**14):
        blocks = size // L.BLOCK_BYTES * 2
        levels = L.Levels(size, blocks)
        assert len(levels.parts) <= 3
        before = 1
        for k, parts in enumerate(levels.parts):
            assert parts <= before * L.FAN
            assert parts * levels.groups[k] <= 2 * max(blocks, parts)
            before = parts
        senders = levels.groups[-2] if len(levels.groups) > 1 else blocks
        assert levels.parts[-1] * L.PART_BYTES >= size and senders <= 4 * L.FAN


def test_a_row_that_repeats_fills_no_block(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_BYTES", 2_000)
    rows = [(0, "the same words again")] * 900 + [(i, f"text {i}") for i in range(1, 400)]
    seen = []
    monkeypatch.setattr(L, "corpus_counts", lambda dealt, levels, f=L.corpus_counts: (seen.append(dealt), f(dealt, levels))[1])
    compare(rows, L.score_texts(table(spark, rows).repartition(4)))
    assert seen[0].filter("role <> 1").select("block").distinct().count() > 8


def test_edges(edges, empty):
    compare(EDGES, L.score_texts(edges))
    assert L.score_texts(empty).count() == 0


def test_no_training_rows(spark):
    rows = [(i, f"a b {i}") for i in range(40) if fold(i) == 1]
    compare(rows, L.score_texts(table(spark, rows)))


def test_held_out_texts_gain_from_context(spark):
    rows = L.query(spark, SMOKE_DIR).filter("held_out").collect()
    assert sum(r.score for r in rows) > 1.05 * sum(r.base_score for r in rows)


def test_packing_of_counts():
    x = np.array([0, 5, 2**40, 7], np.int64)
    assert (L.unpack(L.pack(x), np.int64) == x).all() and len(L.unpack(b"", np.int64)) == 0


def test_buckets_cover_any_count():
    counts = np.array([0] + [1 << k for k in range(63)], dtype=np.int64)
    assert L.bucket_of(counts).tolist() == list(range(64))
