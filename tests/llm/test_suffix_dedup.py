from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from blotter.llm import suffix_dedup as S
from blotter.llm.collection_bwt import AlignedTransform
from tests.conftest import SMOKE_DIR
from tests.llm.conftest import EDGES, prose, table


def expected(rows, window):
    blobs = [(t or "").encode() for _, t in rows]
    count = collections.Counter(b[i : i + window] for b in blobs for i in range(len(b) - window + 1))
    out = []
    for (i, _), b in zip(rows, blobs):
        mark = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if count[b[k : k + window]] > 1:
                mark[k : k + window] = b"\1" * window
        edge = [k for k in range(len(b) + 1) if (k > 0 and mark[k - 1]) != (k < len(b) and mark[k])]
        out.append((i, len(b), list(zip(edge[::2], edge[1::2])), bytes(x for x, m in zip(b, mark) if not m)))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r[0], r.n_bytes, [(s.a, s.b) for s in r.removed], bytes(r.kept)) for r in frame.collect()), key=str)


def test_aligned_transform_against_counting():
    rng = random.Random(1)
    for _ in range(400):
        most = rng.choice([1, 2, 3, 5, 8])
        strings = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 25))) for _ in range(rng.randrange(1, 12))]
        strings += [strings[0]] * rng.choice([0, 2])
        offset = np.array([rng.randrange(len(s)) for s in strings])
        group = np.sort(np.array([rng.randrange(3) for _ in strings]))
        places = [(k, i) for k, s in enumerate(strings) for i in range(len(s) - most + 1)]
        name = lambda k, i: (group[k], i - offset[k], strings[k][i : i + most])
        count = collections.Counter(name(*p) for p in places)
        with AlignedTransform(strings, offset, group, most) as t:
            which, start = t.repeated_starts()
        assert sorted(zip(which.tolist(), start.tolist())) == [p for p in places if count[name(*p)] > 1]


def test_every_window_is_in_one_segment(monkeypatch):
    rng = random.Random(2)
    blobs = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(900))) for _ in range(40)] + [b"a" * 700, b""]
    for stretch in (S.STRETCH, 150):
        monkeypatch.setattr(S, "STRETCH", stretch)
        (text, start, anchor, offset, windows, _), content = S.segments(blobs)
        parts = content(np.arange(len(text)))
        seen = collections.Counter()
        anchors = {}
        for t, s, a, o, w, part in zip(text, start, anchor, offset, windows, parts):
            assert part == blobs[t][s : s + w + S.WINDOW - 1]
            for k in range(w):
                seen[t, s + k] += 1
                window = part[k : k + S.WINDOW]
                assert anchors.setdefault(window, (a, o - k)) == (a, o - k)  # equal windows meet
        assert seen == collections.Counter({(t, i): 1 for t, b in enumerate(blobs) for i in range(len(b) - S.WINDOW + 1)})


def rows():
    rng = random.Random(4)
    passage, line = prose(1, 90), prose(2, 40)
    out = [(i, f"{prose(100 + i, 30)} {passage} {prose(200 + i, rng.randrange(60))}") for i in range(12)]
    out += [(20 + i, f"{prose(300 + i, 20)}\n{line}\n{prose(400 + i, 20)}") for i in range(40)]
    base = prose(3, 300).split()
    for i in range(30):
        words = list(base)
        words[rng.randrange(300)] = "edit"
        out.append((70 + i, " ".join(words)))
    return [*out, (200, "ab" * 400), (201, None), (202, "é" * 150), (203, "é" * 99 + "x")]


@pytest.mark.parametrize("most", [S.MOST_STRINGS, 3])
def test_against_counting_all_windows(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MOST_STRINGS", most)
    monkeypatch.setattr(S, "STRINGS", 20)
    mine = rows()
    assert got(S.remove_repeats(table(spark, mine).repartition(4))) == expected(mine, S.WINDOW)


def test_edges(edges, empty):
    assert got(S.remove_repeats(edges)) == expected(EDGES, S.WINDOW)
    assert S.remove_repeats(empty).count() == 0


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, sum(b - a for a, b in cut), len(cut), hashlib.sha256(kept).hexdigest()) for i, n, cut, kept in expected(docs, 200)}
    assert {r[0]: tuple(r)[1:] for r in S.query(spark, SMOKE_DIR).collect()} == want
