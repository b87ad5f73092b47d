"""The pipeline against its stages' rules in plain Python."""

from __future__ import annotations

import corpus_pipeline as C
from blotter.llm import packing, secrets
from tests.llm.conftest import prose, table
from tests.llm.test_exact_dedup import norm
from tests.llm.test_near_dedup import edited, expected
from tests.llm.test_packing import check
from tests.llm.test_repetition import brute

KEY = "Zx9Kq2Lm8Vt4Wn6Rb1Yc3Df5Gh7Jk0Ps"


def rows():
    out = [(i, prose(i, 60 + i)) for i in range(30)]
    out += [(100 + i, edited(prose(3, 63), i % 2, i)) for i in range(5)]
    out += [(200, prose(5, 65).replace(" ", "\n")), (201, f"{prose(50, 80)} {KEY}"), (202, "short"), (203, None), (204, "again " * 90)]
    return [*out, (205, f"{prose(60, 70)}\n{prose(61, 40)}\n{prose(60, 70)}")]


def test_run(spark, tmp_path):
    mine = rows()
    table(spark, mine).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    kept = [(i, t) for i, t in mine if brute(t or "")[6]]
    first = {}
    for i, t in sorted(kept):
        first.setdefault(norm(t), (i, t))
    near = {i for i, _, c in expected(list(first.values()), 5) if i == c}
    texts = {i: t for i, t in first.values() if i in near}
    assert 0 < len(texts) < len(first) < len(kept) < len(mine)
    texts[201] = texts[201].replace(KEY, "[SECRET]")
    got = C.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(texts)
    check(got, texts)


def test_stages_on_edges(spark, edges, empty):
    assert [name for name, _ in C.STAGES] == ["quality", "exact_dedup", "near_dedup", "secrets", "packing"]
    for docs in (edges, empty):
        for name, stage in C.STAGES:
            out = stage(spark, docs, "")
            assert name == "packing" or out.columns == docs.columns
            assert docs is not empty or out.count() == 0


def test_packing_and_marks():
    assert packing.MAX_LEN == 1024 and secrets.MAX_OWNERS >= 1
