from __future__ import annotations

import collections
import random
import re

import numpy as np

from blotter.llm import repetition as R
from tests.llm.conftest import EDGES, prose


def longest(words):
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            out[i], out[j] = max(out[i], k), max(out[j], k)
    return out


def brute(t, least=R.MIN_WORDS):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    n, far = len(words), longest(words)
    three = collections.Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    again = {i + k for i in range(n - 2) if three[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, lines = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    covered = {x for i in range(n) if far[i] >= least for x in range(i, i + far[i])}
    most = max((x for x in far if x >= least), default=0)
    failed = n < 50 or 100 * len(again) > 50 * n
    kept = not failed and len(covered) <= R.MAX_COVERED * n and most <= R.MAX_LONGEST
    return [n, sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), lines, len(again), failed, kept, len(covered), most]


def test_against_brute_force():
    rng = random.Random(1)
    texts = ["", " \n\t", "a " * 40, "a b c d e f g h i j k l " * 3]
    for _ in range(80):
        size = rng.choice([2, 4, 30, 300])
        text = rng.choice(" \n").join(rng.choice("abcdé#<") + str(rng.randrange(size)) for _ in range(rng.randrange(140)))
        texts.append(text + "\n" + text[: rng.randrange(300)] if rng.random() < 0.5 else text)
    got = R.judge(texts)
    for k, t in enumerate(texts):
        assert [np.asarray(c)[k] for c in got] == brute(t), t


def test_verdicts():
    passage = prose(5, 60)
    clean, repeated, long = prose(6, 300), f"{passage}\n{prose(7, 60)}\n{passage}", prose(8, 200)
    kept = R.judge([clean, repeated, f"{long} {prose(9, 900)} {long}", ""])[6]
    assert list(kept) == [True, False, False, False]


def test_edges(edges, empty):
    rows = R.repetition_rules(edges).collect()
    assert len(rows) == len(EDGES)
    short = {t: brute(t or "") for _, t in EDGES if len(t or "") < 3000}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    for r in rows:
        if r.text in short:
            assert [r[c] for c in names] == short[r.text][:7]
    kept = R.drop_rejected(edges)
    assert kept.columns == edges.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)
    assert R.repetition_rules(empty).count() == 0 and R.drop_rejected(empty).count() == 0
