from __future__ import annotations

import random

import pytest

from blotter.llm import automaton as A
from blotter.llm.tokens import Vocabulary, default_vocabulary
from tests.conftest import SMOKE_DIR
from tests.llm.conftest import EDGES

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(default_vocabulary())


def same(library, texts):
    c = A.codec(default_vocabulary())
    for t, e, ids in zip(texts, library.encode_batch(texts, add_special_tokens=False), c.encode(texts)):
        assert e.ids == ids.tolist(), t
        assert library.decode(e.ids, skip_special_tokens=False) == c.decode(ids.tolist()) == t


def test_ids_of_the_library(library):
    rng = random.Random(3)
    same(library, ["", " ", " a  b ", "a" * 999, "foo  <|endoftext|> bar<|endoftext|>", "x \n y\n\n  z\t\t w ", "I'll don't 'S", "\r\n a\xa0b　c\x85d \x1c e\x1f"])
    same(library, ["".join(rng.choice("abcde  \n\t.,'’é中1<|>#-ſ\x85") for _ in range(rng.randrange(60))) for _ in range(3000)])
    same(library, ["".join(rng.choice("abthein g") for _ in range(rng.randrange(300))) for _ in range(500)])


def test_every_white_space_and_letter_class(library):
    for k in [*range(0x3100), 0x180E, 0xFEFF, 0x1F600]:
        if not 0xD800 <= k < 0xE000:
            c = chr(k)
            text = f"a{c}b {c} 1{c}2  {c}{c} .{c}"
            assert library.encode(text, add_special_tokens=False).ids == A.codec(default_vocabulary()).encode([text])[0].tolist(), hex(k)


def test_gadgets_agree_with_merging_by_rank():
    """A small vocabulary with self-merges, against merging the best pair again and again."""

    class Small:
        label = {i: bytes([97 + i]) for i in range(3)}
        merges = []

    rng = random.Random(9)
    for _ in range(30):
        v = Small()
        v.label, v.merges = dict(Small.label), []
        while len(v.merges) < 12:
            sample = [rank_merge(bytes(rng.choice(b"abc") for _ in range(12)), v) for _ in range(5)]
            a, b = rng.choice([p for s in sample for p in zip(s, s[1:])])
            if v.label[a] + v.label[b] not in v.label.values():
                new = len(v.label)
                v.label[new] = v.label[a] + v.label[b]
                v.merges.append((a, b, new))
        auto = A.MergeAutomaton(v)
        for _ in range(200):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 20)))
            assert auto.encode(word) == rank_merge(word, v), (word, v.merges)


def rank_merge(word, v):
    ids = [c - 97 for c in word]
    for a, b, w in v.merges:
        out, i = [], 0
        while i < len(ids):
            if i + 1 < len(ids) and (ids[i], ids[i + 1]) == (a, b):
                out.append(w)
                i += 2
            else:
                out.append(ids[i])
                i += 1
        ids = out
    return ids


def test_round_trip_of_a_table(spark, edges, empty):
    rows = A.decode(A.encode(edges)).select("text", "ids", "decoded").collect()
    assert len(rows) == len(EDGES) and all(r.decoded == (r.text or "") for r in rows)
    assert A.decode(A.encode(empty)).count() == 0


def test_query(spark, library):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()}
    for r in A.query(spark, SMOKE_DIR).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_vocabulary_reads_merges_by_rank():
    v = Vocabulary(default_vocabulary())
    assert len(v.merges) == 50_000 and v.special == {"<|endoftext|>": 50256}
