from __future__ import annotations

import base64
import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm import alignment as A
from tests.llm.conftest import EDGES, prose, table


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as P
    import sentencepiece
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    a = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def tokens(text, libraries):
    """Whole-text ids and bytes of both, without spans or segments; None: no tokens."""
    if not text:
        return None
    a, b = libraries
    ids_a, ids_b = a.encode_ordinary(" " + text), b.encode(text)
    bytes_a = [a.decode_single_token_bytes(i) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    whole = (" " + text).encode()
    return (ids_a, ids_b, bytes_a, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else None


def brute(rows, libraries):
    made, count = [], Counter()
    for i, text in rows:
        t = tokens(text, libraries)
        if t is None:
            made.append((i, 0, 0, [], []))
            continue
        ids_a, ids_b, bytes_a, bytes_b = t
        owner = [[k for k, part in enumerate(parts) for _ in part] for parts in (bytes_a, bytes_b)]
        links = sorted({(x, y) for x, y in zip(*owner)})
        ends = [{sum(map(len, parts[: k + 1])) for k in range(len(parts))} if len(parts) < 400 else None for parts in (bytes_a, bytes_b)]
        if None in ends:
            import itertools

            ends = [set(itertools.accumulate(map(len, parts))) for parts in (bytes_a, bytes_b)]
        groups, cuts = [], sorted(ends[0] & ends[1])
        at = [0, 0]
        place = [0, 0]
        for cut in cuts:
            sides = []
            for s, (ids, parts) in enumerate(((ids_a, bytes_a), (ids_b, bytes_b))):
                side = []
                while place[s] < cut:
                    side.append(ids[at[s]])
                    place[s] += len(parts[at[s]])
                    at[s] += 1
                sides.append(",".join(map(str, side)))
            groups.append("|".join(sides))
        pairs = [(ids_a[x], ids_b[y]) for x, y in links]
        count.update(set(pairs))
        made.append((i, len(ids_a), len(ids_b), groups, pairs))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return sorted(
        ((i, na, nb, len(g), len(p), sum(count[x] == most[x[0]] for x in p), sum(count[x] for x in p),
          hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, na, nb, g, p in made),
        key=repr,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    (20, "Zażółć  gęślą\n\n\n  jaźń\tx"), (21, "日本語のテキスト 한국어"), (22, "\U0001f600\U0001f468‍\U0001f469 ok \U000e0041"), (23, "a▁b plain"),
    (24, "<|endoftext|> <s> </s> <unk> <0x41>"), (25, "x\r\ny();\r\n{\r z \r\n"), (26, "\x0ba\x0cb \x1c c　　 d\xa0 e f  g"), (27, "it's I'll 12345 don't"),
    (28, "\n\nlead"), (29, "   "), (30, "é́́ é"), (31, "\x00 a"), (32, "tail   "), (33, "a" * 3000), (34, "é" * 700 + "\U0001f600" * 50), (35, "▁"),
    (36, "0 "), (37, " "), (38, "a \n"), (39, "a\n "), (40, "  "), (41, "\n"), (42, "\r"), (43, "x \t y"), (44, "\u3000"), (45, "é "),
]


@pytest.mark.parametrize("block_bytes", [A.BLOCK_BYTES, 400])
def test_brute_force(spark, libraries, block_bytes):
    rows = [*EDGES, *ODD]
    got = A.align(table(spark, rows).repartition(3), block_bytes=block_bytes).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, libraries)


@pytest.fixture(scope="module")
def aligner():
    return A.Aligner(A.Pair(*A.default_vocabularies()))


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t\r;){}'sé▁　\xa0aZ09"), st.characters(codec="utf-8")), max_size=30), max_size=6))
def test_any_text(libraries, aligner, texts):
    columns, of, number, times, pairs = aligner(texts)
    for k, text in enumerate(texts):
        want = brute([(k, text)], libraries)[0]
        assert [int(columns[c][k]) for c in COLUMNS[1:5]] == list(want[1:5]), text
        assert columns["groups_sha256"][k] == want[-1]
        assert int(times[of == k].sum()) == want[4]


def test_spans_are_refined_with_bytes():
    # an added space, then three byte-fallback tokens in one span, then a letter
    assert A.token_ends([(0, 0), (0, 3), (3, 3), (3, 3), (3, 6), (6, 7)], [1, 2, 1, 1, 1, 1]) == [1, 3, 4, 5, 6, 7]
    # tokens that share a character
    assert A.token_ends([(0, 4), (0, 4), (4, 5)], [2, 2, 1]) == [2, 4, 5]
    assert A.token_ends([(0, 4), (0, 4)], [2, 1]) is None


def test_nothing_but_rows_without_tokens(spark, empty):
    assert A.align(empty).count() == 0
    got = A.align(table(spark, [(1, None), (2, ""), (3, "a▁b"), (None, "")])).select(*COLUMNS).collect()
    assert sorted(((r.doc_id, *r[1:]) for r in got), key=repr) == sorted(((i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3, None)), key=repr)


def test_query_on_whole_documents(spark, libraries):
    from tests.conftest import SMOKE_DIR

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = A.query(spark, SMOKE_DIR).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, libraries)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 4)), min_size=1, max_size=12))
def test_all_ends_agree(parts):
    """Spans as libraries give them: sure ends, and runs that share one span."""
    import numpy as np

    spans, sizes, at = [], [], 0
    for extra, size in parts:
        sizes += [1] * extra + [size]
        stop = at + extra + size
        spans += [(at, at)] * extra + [(at, stop)]
        at = stop
    assert A.all_ends(np.array(spans), np.array(sizes)).tolist() == A.token_ends(spans, sizes) == np.cumsum(sizes).tolist()


def test_segments_seen_again_are_not_aligned_again(monkeypatch):
    """A full table drops what was not seen lately, not what every text holds."""
    monkeypatch.setattr(A, "HELD_BYTES", 400_000)
    pair = A._pair(*A.default_vocabularies())
    aligner, fed = A.Aligner(pair), []
    align = pair.align
    monkeypatch.setattr(pair, "align", lambda strings: fed.extend(strings) or align(strings))
    texts = [" ".join(["of the", *(f"q{t}x{w}z" for w in range(300))]) for t in range(12)]
    got = [aligner([t])[0]["groups_sha256"] for t in texts]
    assert fed.count(" of") == 1 and aligner.held < 800_000
    assert got == [A.Aligner(pair)([t])[0]["groups_sha256"] for t in texts]


def test_tasks_of_a_worker_share_their_segments():
    paths = A.default_vocabularies()
    assert A._aligner(*paths) is A._aligner(*paths)
