"""Alignment of two tokenizers over the same bytes, with corpus-wide link counts.

Both tokenizers encode a text that begins with a space. Where both have a token
end, the text is cut into groups; an A and a B token that share a byte are
linked. The ends come from the spans that the libraries give: character offsets
of a tokenizers encoding, and the spans of the sentencepiece proto. They are
coarse: tokens that share a character, byte-fallback tokens and an added space
have no ends of their own there. A run of tokens between two sure ends is refined
with the bytes that its tokens decode to.

A text is first cut into segments, where no word of A's pattern and no merge of B
reaches over, and a distinct segment is aligned once, many of them (between line
feeds, which neither tokenizer joins with what follows) as one text. Tasks work on
blocks of documents: a block counts the documents of each distinct pair before
anything is shuffled, and gets the corpus-wide counts of its pairs back.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from blotter.llm.common import SPACE, documents, slices, span_hashes, texts_of, trim, written
from blotter.llm.tokens import _ODD, Vocabulary

#: Bytes of text in a block.
BLOCK_BYTES = 16_000_000
#: Bytes of aligned segments that a worker holds, each counted with its place in the table.
HELD_BYTES, _ENTRY = 100_000_000, 400
_MARK = "▁"
#: Segments that are encoded as one text.
_AT_ONCE = 512


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ spans


def token_ends(spans: list[tuple[int, int]], sizes: list[int]) -> list[int] | None:
    """The byte each token ends at, from coarse spans (bytes) and the bytes of
    each token. A span's end is sure if it lies beyond the last sure one and the
    next span does not begin before it. Null where the two don't fit together."""
    ends: list[int] = []
    sure, run = 0, 0
    for i, (_, end) in enumerate(spans):
        if end <= sure or i + 1 < len(spans) and spans[i + 1][0] < end:
            run += 1
            continue
        if run:  # tokens without ends of their own: by their bytes
            at = sure
            for size in sizes[i - run : i + 1]:
                at += size
                ends.append(at)
            run = 0
        else:
            at = sure + sizes[i]
            ends.append(end)
        if at != end:
            return None
        sure = end
    return None if run else ends


def all_ends(spans: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
    """``token_ends`` for many tokens at once."""
    n, end = len(spans), spans[:, 1]
    before = np.concatenate([[0], np.maximum.accumulate(end)[:-1]])
    sure = (end > before) & np.append(spans[1:, 0] >= end[:-1], True)
    by_bytes = np.cumsum(sizes)
    if not n or not sure[-1] or (by_bytes[sure] != end[sure]).any():
        return None
    # a token without a sure end: its bytes and those before it, from the last sure end on
    last = np.maximum.accumulate(np.where(sure, np.arange(n), -1))
    return np.where(sure, end, np.where(last >= 0, end[last] - by_bytes[last], 0) + by_bytes)


class Pair:
    """The two tokenizers, and where texts may be cut for both."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a_bytes = Vocabulary(byte_path).label
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode("utf-8", "surrogatepass") for i, p in enumerate(pieces)
        ]
        self.kind = self._kind()
        probe = "é x"
        self.in_bytes = self._protos([probe])[0].pieces[-1].end == len(probe.encode())
        # Characters that stand next to each other in a piece: no merge reaches over others.
        beside = {(" " if x == _MARK else x, " " if y == _MARK else y) for p in pieces for x, y in zip(p, p[1:])}
        #: White space that follows nothing but itself in a piece; of this, what is beside nothing at all.
        self.breaks, self.lone = np.zeros(256, bool), np.zeros(256, bool)
        for c in " \t\n\x0b\x0c\r":
            self.breaks[ord(c)] = not any(y == c and x != c for x, y in beside)
            self.lone[ord(c)] = not any(c in pair for pair in beside)
        #: Pairs of ASCII characters that A's pattern always parts and no piece of B has side by side.
        self.part = np.zeros((256, 256), bool)
        kind = np.full(128, 2)
        kind[[*range(65, 91), *range(97, 123)]] = 0
        kind[48:58] = 1
        kind[39] = 3
        apart = np.array([[0, 1, 1, 1], [1, 0, 1, 1], [1, 1, 0, 0], [0, 1, 0, 0]], bool)
        solid = ~SPACE[:128]
        self.part[:128, :128] = apart[kind[:, None], kind[None, :]] & solid[:, None] & solid[None, :]
        for x, y in beside:
            if x < "\x80" and y < "\x80":
                self.part[ord(x), ord(y)] = False
        self.joins = bool(self.lone[10]) and self.a.encode("a\nb c", add_special_tokens=False).offsets[1] == (1, 2)
        self.a_size = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)])
        self.b_size = np.array([len(p) for p in self.b_bytes])

    def _kind(self) -> dict:
        """How this release of sentencepiece calls a proto with spans."""
        for kind in ({"return_type": "proto"}, {"out_type": "immutable_proto"}):
            try:
                self.b.encode("a", **kind).pieces
            except (TypeError, ValueError, AttributeError):
                continue
            return kind
        raise RuntimeError("this sentencepiece gives no spans")

    def _protos(self, strings: list[str]) -> list:
        return self.b.encode(strings, num_threads=1, **self.kind)

    def align(self, strings: list[str]) -> list[tuple | None]:
        """The entry of each string: (groups, n_a, n_b, n_groups, packed pairs), or None."""
        out: list[tuple | None] = [None] * len(strings)
        joined = [k for k, s in enumerate(strings) if self.joins and not s[-1].isspace() and not (s[0].isspace() and (s[0] != " " or s[1].isspace()))]
        chunks = [joined[i : i + _AT_ONCE] for i in range(0, len(joined), _AT_ONCE)]
        texts = ["\n" + "\n".join([strings[k] for k in chunk]) for chunk in chunks]
        alone = sorted(set(range(len(strings))) - set(joined))
        if chunks:
            encodings = self.a.encode_batch(texts, add_special_tokens=False)
            for chunk, text, e, p in zip(chunks, texts, encodings, self._protos(texts)):
                entries = self._together(text, [strings[k] for k in chunk], e, p)
                if entries is None:  # some string is not what its tokens decode to
                    alone += chunk
                else:
                    for k, entry in zip(chunk, entries):
                        out[k] = entry
        some = [strings[k] for k in alone]
        # B puts a space before a text: it stands for the one that a string begins with.
        spaced = [s[0] == " " and len(s) > 1 for s in some]  # an empty text would get none
        fed = [s if own or s[0] in "\t\n\v\f\r" else "\n" + s for s, own in zip(some, spaced)]
        protos = self._protos([s[1:] if own else s for s, own in zip(fed, spaced)]) if some else []
        encodings = self.a.encode_batch(some, add_special_tokens=False) if some else []
        for k, s, own, e, p in zip(alone, some, spaced, encodings, protos):
            out[k] = self._aligned(s, own, e, p)
        return out

    def _together(self, text: str, strings: list[str], encoding, proto) -> list[tuple] | None:
        """The entries of strings with a line feed before each."""
        raw = text.encode("utf-8", "surrogatepass")
        a_ids, pieces = encoding.ids, list(proto.pieces)
        b_ids = [p.id for p in pieces]
        if not b_ids or self.b_bytes[b_ids.pop(0)] != b" ":  # the added space
            return None
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != raw or b"".join(map(self.b_bytes.__getitem__, b_ids)) != raw:
            return None
        del pieces[0]
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_span = np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        b_span = np.empty((len(b), 2), np.int64)
        b_span[:, 0], b_span[:, 1] = [p.begin for p in pieces], [p.end for p in pieces]
        if len(raw) != len(text):  # characters to bytes
            at = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw))
            a_span = at[a_span]
            if not self.in_bytes:
                b_span = at[b_span]
        a_end, b_end = all_ends(a_span, self.a_size[a]), all_ends(b_span, self.b_size[b])
        if a_end is None or b_end is None:
            return None
        same = len(raw) == len(text)
        stop = np.cumsum([len(s if same else s.encode("utf-8", "surrogatepass")) + 1 for s in strings])
        feed = np.concatenate([[1], stop[:-1] + 1])  # ends of the line feeds
        sides = []
        for ids, end, size in ((a, a_end, self.a_size[a]), (b, b_end, self.b_size[b])):
            # the ends ascend, as each token has a byte
            at = np.searchsorted(end, feed)
            if (end[np.minimum(at, len(end) - 1)] != feed).any() or (size[at] != 1).any() or (end[np.searchsorted(end, stop)] != stop).any():
                return None
            is_feed = np.zeros(len(end), bool)
            is_feed[at] = True
            sides.append((ids[~is_feed], end[~is_feed]))
        (a, a_end), (b, b_end) = sides
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        cuts = np.union1d(a_end, b_end)  # between two cuts lies one token of each
        links = a[np.searchsorted(a_end, cuts)] << 32 | b[np.searchsorted(b_end, cuts)]
        count = [np.diff(np.searchsorted(x, np.concatenate([[0], stop]), "right")) for x in (a_end, b_end, ends, cuts)]
        packed, edge = links.astype("<i8").tobytes(), np.concatenate([[0], 8 * np.cumsum(count[3])]).tolist()
        return list(zip(self._texts(a, a_end, b, b_end, ends, stop), *(c.tolist() for c in count[:3]), [packed[x:y] for x, y in zip(edge, edge[1:])]))

    @staticmethod
    def _texts(a, a_end, b, b_end, ends, stop) -> list[bytes]:
        """The groups of each string as text."""
        group = np.concatenate([np.searchsorted(ends, a_end) * 2, np.searchsorted(ends, b_end) * 2 + 1])
        order = np.argsort(group, kind="stable")
        ids, group = np.concatenate([a, b])[order].tolist(), group[order]
        mark = np.zeros(len(group), np.int64)  # inside one side of a group: a comma
        last = np.append(group[1:] != group[:-1], True)
        mark[last] = 1 + group[last] % 2  # after the A side a bar, after the B side a semicolon
        final = np.zeros(len(ends), bool)
        final[np.searchsorted(ends, stop)] = True
        mark[last & (group % 2 == 1) & final[group // 2]] = 3
        return "".join([f"{i}{m}" for i, m in zip(ids, np.array([",", "|", ";", "\n"])[mark].tolist())]).encode().split(b"\n")[:-1]

    def _aligned(self, s: str, spaced: bool, encoding, proto) -> tuple | None:
        raw = s.encode("utf-8", "surrogatepass")
        a, b = encoding.ids, [p.id for p in proto.pieces]
        b_spans = [(p.begin, p.end) for p in proto.pieces]
        if not spaced:  # the added space is a piece of its own, and a line feed fed before
            fed = s[0] not in "\t\n\v\f\r"
            if len(b) <= fed or self.b_bytes[b[0]] != b" " or fed and self.b_bytes[b[1]] != b"\n":
                return None
            b, b_spans = b[1 + fed :], [(x - fed, y - fed) for x, y in b_spans[1 + fed :]]
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(a_parts) != raw or b"".join(b_parts) != raw:
            return None
        if len(a) == len(b) == 1:
            return b"%d|%d" % (a[0], b[0]), 1, 1, 1, (a[0] << 32 | b[0]).to_bytes(8, "little")
        a_spans = encoding.offsets
        if len(raw) != len(s):  # characters to bytes
            at = np.concatenate([[0], np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in s])]).tolist()
            a_spans = [(at[x], at[y]) for x, y in a_spans]
            if not self.in_bytes:
                b_spans = [(at[x + spaced] - spaced, at[y + spaced] - spaced) for x, y in b_spans]
        if spaced:
            b_spans = [(x + 1 if x else 0, y + 1) if y else (0, 0) for x, y in b_spans]
        a_ends, b_ends = token_ends(a_spans, [len(p) for p in a_parts]), token_ends(b_spans, [len(p) for p in b_parts])
        if a_ends is None or b_ends is None:
            return None
        return self._grouped(a, b, a_ends, b_ends)

    @staticmethod
    def _grouped(a: list[int], b: list[int], a_ends: list[int], b_ends: list[int]) -> tuple:
        groups, links, i, j, i0, j0 = [], [], 0, 0, 0, 0
        while i < len(a):
            links.append(a[i] << 32 | b[j])
            x, y = a_ends[i], b_ends[j]
            if x == y:
                groups.append(",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1])))
                i0, j0 = i + 1, j + 1
            i, j = i + (x <= y), j + (y <= x)
        return ";".join(groups).encode(), len(a), len(b), len(groups), np.array(links, "<i8").tobytes()


@lru_cache(maxsize=1)
def _pair(byte_path: str, piece_path: str) -> Pair:
    return Pair(byte_path, piece_path)


# ------------------------------------------------------------------ blocks


class Aligner:
    """Aligns texts by their distinct segments, which a worker holds by hash: those
    seen lately, and as many seen before them, which go unless they are seen again."""

    def __init__(self, pair: Pair):
        self.pair, self.known, self.older, self.held = pair, {}, {}, 0

    def _entries(self, keys: list[int], string) -> list[tuple | None]:
        if self.held > HELD_BYTES // 2:
            self.known, self.older, self.held = {}, self.known, 0
        known, older, new = self.known, self.older, []
        for k, key in enumerate(keys):
            if key in known:
                continue
            if key in older:
                known[key] = older.pop(key)
                self.held += self._size(known[key])
            else:
                new.append(k)
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            for k, entry in zip(some, self.pair.align([string(k) for k in some])):
                known[keys[k]] = entry
                self.held += self._size(entry)
        return [known[k] for k in keys]

    @staticmethod
    def _size(entry: tuple | None) -> int:
        return _ENTRY + (len(entry[0]) + len(entry[4]) if entry else 0)

    def segments(self, blobs: list[bytes], odd: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of some texts, and start, end and text of their segments.
        An odd text, with white space of other kinds, is one segment."""
        data = np.frombuffer(b"\n".join([b"", *blobs, b""]), np.uint8)
        size = np.fromiter(map(len, blobs), np.int64, len(blobs))
        stop = np.cumsum(size + 1)
        begin = stop - size
        cut = np.zeros(len(data) + 1, bool)
        space = SPACE[data]
        cut[1 : len(data)] = self.pair.breaks[data[1:]] & ~space[:-1] | self.pair.part[data[:-1], data[1:]]
        # after one white space of a kind that is in no piece
        cut[2 : len(data)] |= self.pair.lone[data[1:-1]] & ~space[:-2] & ~space[2:]
        for k in np.flatnonzero(odd):
            cut[begin[k] : stop[k]] = False
        cut[begin] = cut[stop] = True
        start = np.flatnonzero(cut[:-1])
        of = np.searchsorted(begin, start, "right") - 1
        kept = (of >= 0) & (start < stop[of])
        start, of = start[kept], of[kept]
        end = np.append(start[1:], 0)
        last = np.append(of[1:] != of[:-1], True)
        return data, start, np.where(last, stop[of], end), of

    def __call__(self, texts: list[str]) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The columns of each text; then the distinct pairs of the texts as
        (text, number of the pair, times linked), and the pairs by number."""
        n = len(texts)
        blobs = [(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        some = [k for k in range(n) if blobs[k]]
        none = np.zeros(0, np.int64)
        columns = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")} | {"groups_sha256": [""] * n}
        if not some:
            return columns, none, none, none, none
        data, start, end, of = self.segments([blobs[k] for k in some], [bool(_ODD.search(texts[k])) for k in some])
        code, distinct = pd.factorize(span_hashes(data, start, end))
        one = np.empty(len(distinct), np.int64)
        one[code[::-1]] = np.arange(len(code))[::-1]
        raw = data.tobytes()
        entries = self._entries(distinct.tolist(), lambda k: raw[start[one[k]] : end[one[k]]].decode("utf-8", "surrogatepass"))
        wrong = np.fromiter((e is None for e in entries), bool, len(entries))
        bad = np.bincount(of, wrong[code], len(some)) > 0  # a text has tokens only if all its segments have
        good = ~bad[of]
        code, of = code[good], of[good]
        text = np.array(some)
        for place, name in ((1, "n_a"), (2, "n_b"), (3, "n_groups")):
            each = np.fromiter((e[place] if e else 0 for e in entries), np.int64, len(entries))
            columns[name][text] = np.bincount(of, each[code], len(some)).astype(np.int64)
        n_links = np.fromiter((len(e[4]) // 8 if e else 0 for e in entries), np.int64, len(entries))
        columns["n_links"][text] = np.bincount(of, n_links[code], len(some)).astype(np.int64)
        strings = [e[0] if e else b"" for e in entries]
        edge = np.searchsorted(of, np.arange(len(some) + 1))
        codes = code.tolist()
        for k, i in enumerate(some):
            if edge[k] < edge[k + 1]:
                columns["groups_sha256"][i] = hashlib.sha256(b";".join([strings[c] for c in codes[edge[k] : edge[k + 1]]])).hexdigest()
        # distinct segments of each text, then the pairs linked in them
        both, times = np.unique(of * len(entries) + code, return_counts=True)
        of, code = np.divmod(both, len(entries))
        links = np.frombuffer(b"".join([e[4] for e in entries if e]), "<i8")
        pairs, number = np.unique(links, return_inverse=True)
        first = np.cumsum(n_links) - n_links
        each = n_links[code]
        at = np.repeat(first[code] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        held = np.repeat(of, each) * max(len(pairs), 1) + number[at]
        order = np.argsort(held, kind="stable")
        held, times = held[order], np.repeat(times, each)[order]
        head = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else none
        total = np.add.reduceat(times, head) if len(held) else none
        of, number = np.divmod(held[head], max(len(pairs), 1))
        return columns, text[of], number, total, pairs


@lru_cache(maxsize=1)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    """One for all tasks of a worker: what one has aligned, the next need not."""
    return Aligner(_pair(byte_path, piece_path))


_DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_INNER = f"block string, id {{id}}, {_DOC}, pairs array<int>, times array<int>, keys array<long>, docs array<int>"


def aligned(docs: DataFrame, id_col: str, text_col: str, byte_path: str, piece_path: str, block_bytes: int) -> DataFrame:
    """A row for each document with the numbers of its pairs in its block, and
    one for each block with the pairs and the documents that hold them."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    inner = StructType.fromDDL(_INNER.format(id="string"))
    inner = StructType([StructField("id", picked.schema["id"].dataType) if f.name == "id" else f for f in inner.fields])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(inner)
        aligner = _aligner(byte_path, piece_path)

        def lists(of: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32)), pa.array(values.astype(np.int32)))

        def flush(held: list):
            name = uuid.uuid4().hex
            keys, number = np.unique(np.concatenate([h[5] for h in held]), return_inverse=True)
            docs, at = np.zeros(len(keys), np.int64), 0
            for ids, columns, of, local, times, pairs in held:
                n, here = len(ids), number[at : at + len(pairs)]
                at += len(pairs)
                docs += np.bincount(here[local], minlength=len(keys))
                arrays = {
                    "block": pa.array([name] * n), "id": ids, **{c: pa.array(v) for c, v in columns.items()},
                    "pairs": lists(of, here[local], n), "times": lists(of, times, n),
                }
                yield pa.RecordBatch.from_arrays([arrays[f.name] if f.name in arrays else pa.nulls(n, f.type) for f in types], names=types.names)
            if len(keys):
                arrays = {"block": pa.array([name]), "keys": pa.array([keys]), "docs": pa.array([docs.astype(np.int32)])}
                yield pa.RecordBatch.from_arrays([arrays[f.name] if f.name in arrays else pa.nulls(1, f.type) for f in types], names=types.names)

        held, size = [], 0
        for part in slices(batches, "text"):
            texts = texts_of(part.column("text"))
            held.append((part.column("id"), *aligner(texts)))
            size += sum(map(len, texts))
            if size >= block_bytes:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)
        trim()

    return picked.mapInArrow(run, inner)


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabularies: tuple[str, str] | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """A row for each row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best
    (links whose pair's count is the highest of its A id), count_sum (of the
    counts of all links) and groups_sha256. A pair's count is the number of
    documents that hold it linked, in the whole table.

    A null or empty text, and one whose tokens do not decode to it (B may read
    a character as a space), has no tokens: zeros and an empty string. Each row
    is a document, whether its id is null or repeats. An empty table gives no
    rows. Other columns are not read.
    """
    paths = vocabularies or default_vocabularies()
    made = written(aligned(docs, id_col, text_col, *paths, block_bytes), "aligned")
    held = made.filter("keys IS NOT NULL").select("block", F.posexplode(F.arrays_zip("keys", "docs")).alias("at", "p"))
    held = held.select("block", "at", F.col("p.keys").alias("pair"), F.col("p.docs").alias("docs"))
    count = written(held.groupBy("pair").agg(F.sum("docs").alias("n")), "pairs")
    best = count.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    judged = count.withColumn("a", F.shiftright("pair", 32)).join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    back = held.select("block", "at", "pair").join(judged, "pair").select(F.col("block").alias("of"), "at", "n", "best")
    rows = made.filter("keys IS NULL").drop("keys", "docs")
    kind = rows.schema["id"].dataType
    schema = StructType([StructField(id_col, kind), *StructType.fromDDL("n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string").fields])

    def judge(left, right):
        import pyarrow as pa

        if not left.num_rows:
            return pa.Table.from_arrays([pa.array([], f.type) for f in _arrow(schema)], names=_arrow(schema).names)
        size = right.num_rows
        n, is_best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = right.column("at").to_numpy()
        n[at] = right.column("n").to_numpy()
        is_best[at] = right.column("best").to_numpy(zero_copy_only=False)
        pairs, times = (left.column(c).combine_chunks() for c in ("pairs", "times"))
        stop = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy(zero_copy_only=False))])
        pair, often = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)

        def total(of_pair: np.ndarray) -> pa.Array:
            sums = np.concatenate([[0], np.cumsum(of_pair[pair] * often)])
            return pa.array(sums[stop[1:]] - sums[stop[:-1]])

        columns = {id_col: left.column("id"), "n_best": total(is_best), "count_sum": total(n)}
        names = _arrow(schema).names
        return pa.Table.from_arrays([columns[c] if c in columns else left.column(c) for c in names], names=names)

    return rows.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(judge, schema)


def _arrow(schema: StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
