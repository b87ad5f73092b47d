from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from blotter.llm import personal_data as P
from tests.conftest import SMOKE_DIR
from tests.llm.conftest import EDGES


def base(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m[0])) <= 19 and P.luhn(digits(m[0]))]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]


def test_base_spans(texts):
    odd = [
        "a@b.c.d@e.f x+1@y-z.co", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4", "4111 1111 1111 1111-4111111111111111", "+1 (2) 3.4-5678 9",
        "+12345678901234567 +1234567", "4111111111111111", "é4111-1111-1111-1111é", "1" * 3000, "+" * 50 + "1 2 3 4 5 6 7 8",
    ]
    for t in [*odd, *texts]:
        assert [(P.KINDS[k], a, b) for k, a, b in P.base_spans(t)] == base(t), t[:200]


def test_field_on_texts_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("text rlike '[0-9@]'").orderBy("doc_id")
    texts = [r.text for r in docs.select("doc_id", "text").collect()]
    half = len(texts) // 2
    field = P.fit(texts[:half])
    hit = missed = false = 0
    for t in texts[half:]:
        gold = {s for s in P.base_spans(t)}
        mine = {s for w in P.runs(t) for s in field.segment(P.Run(t, w))}
        hit, missed, false = hit + len(gold & mine), missed + len(gold - mine), false + len(mine - gold)
    assert hit > 100 and hit / (hit + missed) > 0.95 and hit / (hit + false) > 0.9
    found = P.all_spans("call (663) 555-6869 on 2024-05-01 for 99.50", field)
    assert [(s["kind"], s["start"], s["end"], s["base"]) for s in found] == [("phone", 5, 19, False)]


def test_gradient_against_differences():
    text = "ring +1 (663) 555-6869 a@b.cc 17"
    run, gold = P.examples(text)[0]
    field = P.Field()
    rng = np.random.default_rng(1)
    names = {f for e in run.segments for _, _, fs in e for f in fs}
    for f in names:
        field.weight[f] = rng.normal(size=len(P.LABELS))
    field.step = rng.normal(size=field.step.shape)
    slope, slope_step = field._gradient(run, gold)

    def likelihood():
        score = {(i, j): field._score(i, j, f) for j, e in enumerate(run.segments, 1) for i, _, f in e}
        total = {}

        def walk(at, last, s, path):
            if at == run.n:
                total[tuple(path)] = s
                return
            for (i, j), x in score.items():
                if i == at:
                    for y in range(len(P.LABELS)):
                        if x[y] > -1e9:
                            walk(j, y, s + x[y] + field.step[last, y], [*path, (i, j, y)])

        walk(0, len(P.LABELS), 0.0, [])
        right = tuple((i, j, y) for (i, j), y in sorted(gold.items()))
        return total[right] - np.logaddexp.reduce(list(total.values()))

    run.segments, run.n = run.segments[:4], 4
    gold = {k: y for k, y in gold.items() if k[1] <= 4}
    slope, slope_step = field._gradient(run, gold)
    for f in sorted(names)[:6]:
        if f in slope:
            before = likelihood()
            field.weight[f][4] += 1e-5
            assert (likelihood() - before) / 1e-5 == pytest.approx(slope[f][4], abs=1e-3)
            field.weight[f][4] -= 1e-5
    before = likelihood()
    field.step[5, 4] += 1e-5
    assert (likelihood() - before) / 1e-5 == pytest.approx(slope_step[5, 4], abs=1e-3)


def test_edges(edges, empty):
    field = P.train(edges)
    rows = P.find_personal_data(edges, field)
    assert "personal" in rows.columns and rows.count() == len(EDGES)
    assert P.find_personal_data(empty, P.train(empty)).count() == 0
    assert P.all_spans("9" * 100_000 + " " + "1 " * 5000, field) is not None


def test_query(spark):
    got = {r.doc_id: r for r in P.query(spark, SMOKE_DIR).collect()}
    for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect():
        spans = base(r.text or "")
        row = got[r.doc_id]
        assert [row[f"n_{k}"] for k in P.KINDS] == [sum(s[0] == k for s in spans) for k in P.KINDS]
        digest = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert set(filter(None, digest.split(","))) <= set(row.spans.split(","))


ALPHABET = "aZ09.@-+%_ é(\n"


def test_patterns_on_generated_texts():
    import random

    rng = random.Random(11)
    for _ in range(20_000):
        t = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40)))
        assert [(P.KINDS[k], a, b) for k, a, b in P.base_spans(t)] == base(t), t


@pytest.mark.parametrize("unit", ["x", "7", "x7", "a@", "@", "1.", "+1", ".", "abc.d@ef.gh ", "- "])
def test_a_million_characters(unit):
    """In a time in proportion to the text."""
    import time

    text = unit * (1_000_000 // len(unit)) + " a@b.cc"
    began = time.process_time()
    P.base_spans(text)
    assert time.process_time() - began < 5


def test_segments_against_all_segmentations():
    """The decoder's choice has the highest score of all ways to cut and label a run."""
    rng = np.random.default_rng(3)
    for text in ("ring +1 (663) 555-6869 a@b.cc 17", "4 5 6 7", "a1 b@c 22 3.4.5.6 7-7 8"):
        for words in P.runs(text):
            run = P.Run(text, words)
            field = P.Field()
            for f in sorted({f for e in run.segments for _, _, fs in e for f in fs}):
                field.weight[f] = rng.normal(size=len(P.LABELS))
            field.step = rng.normal(size=field.step.shape)
            score = {(i, j): (span, field._score(i, j, f)) for j, e in enumerate(run.segments, 1) for i, span, f in e}
            every = []

            def walk(at, last, total, path):
                if at == run.n:
                    every.append((total, path))
                    return
                for j in range(at + 1, min(at + P.MAX_WORDS, run.n) + 1):
                    span, s = score[at, j]
                    for y in range(len(P.LABELS)):
                        if y == 0 and j - at > 1:
                            continue
                        more = field.step[last, y] + s[y] - (P.MARGIN if y else 0)
                        walk(j, y, total + more, path + [(y - 1, *span)] * (y > 0))

            walk(0, len(P.LABELS), 0.0, [])
            assert field.segment(run) == max(every, key=lambda e: e[0])[1]
