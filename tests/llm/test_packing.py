from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from blotter.llm import packing as P
from blotter.llm.tokens import default_vocabulary
from tests.llm.conftest import EDGES, prose, table

tokenizers = pytest.importorskip("tokenizers")


def one_by_one(count, max_len):
    bins, count = [], count.copy()
    while count.any():
        lengths, _ = P.fill_bin(count, max_len)
        for x in lengths:
            count[x] -= 1
        bins.append(sorted(lengths))
    return bins


def test_plan_repeats_what_single_bins_would_be():
    rng = random.Random(1)
    for _ in range(100):
        size = rng.choice([10, 30, 64])
        count = np.bincount([rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 200))], minlength=size + 1)
        bins = {}
        for length, first, end, each, start, offset in P.plan(count, size):
            for g in range(end - first):
                bins.setdefault(start + g // each, []).append((offset + g % each * length, length))
        assert [sorted(x for _, x in bins[k]) for k in sorted(bins)] == one_by_one(count, size)
        for places in bins.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= size


def test_best_pair_against_all_pairs():
    rng = random.Random(2)
    for _ in range(200):
        count = np.array([0] + [rng.choice([0, 0, 1, 2]) for _ in range(20)])
        room = rng.randrange(1, 30)
        have = np.flatnonzero(count)
        best = max((a + b for a in have for b in have if a + b <= room and (a != b or count[a] > 1)), default=0)
        assert sum(P.best_pair(count, min(room, 20))) == max((a + b for a in have for b in have if a + b <= min(room, 20) and (a != b or count[a] > 1)), default=0)
        assert best >= 0


def test_smallest_is_replaced_by_two():
    count = np.bincount([7, 2, 2, 1], minlength=11)
    assert P.fill_bin(count, 10)[0] == [7, 2, 1]
    count = np.bincount([6, 3, 2, 2], minlength=11)
    assert P.fill_bin(count, 10)[0] == [6, 2, 2]  # 3 left a gap of 1


def check(rows, texts, max_len=P.MAX_LEN):
    """``texts`` by id, each id once."""
    library = tokenizers.Tokenizer.from_file(default_vocabulary())
    used, by_doc = {}, {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= max_len
    for i, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [P.END_ID]
        mine = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert [r.start for r in mine] == [0, *np.cumsum([r.length for r in mine])[:-1]]
        assert sum(r.length for r in mine) == len(ids) and all(r.length == max_len for r in mine[1:])
        for r in mine:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    return len(used), sum(r.length for r in rows)


def test_packed_rows(spark):
    texts = {i: prose(i, 1 + i * 7) for i in range(150)}
    bins, total = check(P.pack(table(spark, texts.items()).repartition(4)).collect(), texts)
    assert bins <= -(-total // P.MAX_LEN) + 1


def test_other_limits(spark):
    texts = {i: prose(i, i) for i in range(60)}
    check(P.pack(table(spark, texts.items()), max_len=50).collect(), texts, 50)


def test_edges(edges, empty):
    rows = P.pack(edges).collect()
    assert len([r for r in rows if r.piece == 0]) == len(EDGES)
    unique = {i: t for i, t in EDGES if i not in (None, 6)}
    check(rows, unique)
    assert P.pack(empty).count() == 0
