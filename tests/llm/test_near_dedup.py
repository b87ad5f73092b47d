from __future__ import annotations

import random
import re

from blotter.llm import near_dedup as N
from tests.llm.conftest import EDGES, prose, table


def shingles(t, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def expected(rows, k=4):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= 80 * (len(a) + len(b) - common):
                    root[find(i)] = find(j)
    low = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            low[find(x)] = min(i, low.get(find(x), i))
    return sorted(((i, len(s), low.get(find(x)) if s else i) for x, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def answer(frame):
    rows = frame.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def edited(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def mixed():
    """Close and loose groups, chains, pairs around the threshold, a passage that many share."""
    out = []
    for g in range(6):
        base = prose(g, 150 + 20 * g)
        out += [edited(base, k % 9, 50 * g + k) for k in range(16)]
    chain = prose(90, 200)
    for k in range(12):
        chain = edited(chain, 4, 700 + k)
        out.append(chain)
    passage = prose(91, 60)
    out += [f"{prose(800 + k, 50)} {passage} {prose(900 + k, 30)}" for k in range(30)]
    out += ["One two", "one  TWO", "one two three", "", " ", "x" * 300]
    return [(10 * i % 997, t) for i, t in enumerate(out)]


def test_against_all_pairs(spark):
    rows = mixed()
    assert answer(N.near_components(table(spark, rows).repartition(4))) == expected(rows)


def test_large_nodes_branch_and_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "SMALL", 5)
    monkeypatch.setattr(N, "LEVELS", 3)
    rows = mixed()
    assert answer(N.near_components(table(spark, rows))) == expected(rows)


def test_edges(edges, empty):
    assert answer(N.near_components(edges)) == expected(EDGES)
    assert N.near_components(empty).count() == 0 and N.drop_near_copies(empty).count() == 0
    kept = N.drop_near_copies(edges)
    assert kept.columns == edges.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    known = [r for r in EDGES if r[0] is not None]
    want = [i for i, n, c in expected(known, 5) if i == c] + [None, None]
    assert ids == sorted(map(str, want))
