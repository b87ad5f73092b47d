"""BPE by a tokenization automaton.

The merges are compiled, one by one, into a deterministic automaton over
tokens. It starts as a single state with a loop for every byte. The gadget for
the merge (u, v) -> w splits the state that u leads to: u now leads to a copy
without the arc v, every state with an arc u gets an arc w, and w leads where
v led. All states accept, and each word is spelled by the labels of exactly one
path: its BPE tokens. Decoding emits the labels of the arcs.

Arcs of a token lead to one state wherever they start, so the table holds a
target for each token. A copy is stored as (copied state, lost arc, time); an
arc of a younger token exists where the arc of its left part does. Arc tests
are kept in a transition table as they are met.

A word is read byte by byte, each byte one lookup in the table of a second
automaton, over the bytes of the labels, whose state tells which tokens end here.
Every beginning of a word is spelled by one path too, so exactly one of them goes
on from the state that the beginning before it leads to: it is the last token of
the beginning, whatever follows, and nothing is undone.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from blotter.llm.common import documents, with_text_columns
from blotter.llm.tokens import SPLIT, PieceCache, Vocabulary, default_vocabulary

#: Entries of the transition table and of the words held by a worker.
HELD = 400_000


class MergeAutomaton:
    def __init__(self, vocabulary: Vocabulary):
        made = {w for _, _, w in vocabulary.merges}
        self.label = vocabulary.label
        self.token = {label: i for i, label in vocabulary.label.items() if len(label) == 1 or i in made}
        self._read_labels()
        self.left: dict[int, int] = {}
        self.time = dict.fromkeys(self.token.values(), -1)
        self.target = dict.fromkeys((i for label, i in self.token.items() if len(label) == 1), 0)
        self.copied, self.lost, self.since = [-1], [-1], [-1]
        for time, (u, v, w) in enumerate(vocabulary.merges):
            self._add_gadget(time, u, v, w)
        self.table: dict[int, bool] = {}

    def _add_gadget(self, time: int, u: int, v: int, w: int) -> None:
        state = self.target[u]
        if w in self.left or not self.has_arc(state, v):
            raise ValueError(f"merge {time} can never apply")
        self.time[w], self.left[w] = time, u
        self.target[w] = self.target[v]
        self.target[u] = len(self.copied)
        self.copied.append(state)
        self.lost.append(v)
        self.since.append(time)

    def _read_labels(self) -> None:
        """The automaton over bytes: ``step`` (state and byte to state; what is
        not there yet is found by ``fall``, the state of the longest proper end)
        and ``ending``, the tokens that end in a state with their lengths."""
        self.step: dict[int, int] = {}
        token_of, parent = [-1], [(0, 0)]
        for label, t in self.token.items():
            node = 0
            for byte in label:
                key = node << 8 | byte
                node = self.step.get(key, 0)
                if not node:
                    node = self.step[key] = len(token_of)
                    token_of.append(-1)
                    parent.append((key >> 8, byte))
            token_of[node] = t
        own = dict(self.step)  # of the labels alone
        depth = [0] * len(token_of)
        for node in range(1, len(token_of)):  # a node comes after its parent
            depth[node] = depth[parent[node][0]] + 1
        self.fall, self.ending = [0] * len(token_of), [()] * len(token_of)
        for node in sorted(range(1, len(token_of)), key=depth.__getitem__):
            above, byte = parent[node]
            at = self.fall[above] if above else -1
            while at > 0 and (at << 8 | byte) not in own:
                at = self.fall[at]
            self.fall[node] = 0 if at < 0 else own.get(at << 8 | byte, 0)
            mine = ((token_of[node], depth[node]),) if token_of[node] >= 0 else ()
            self.ending[node] = mine + self.ending[self.fall[node]]
        self.own = own

    def _next(self, node: int, byte: int) -> int:
        at = node
        while at and (at << 8 | byte) not in self.own:
            at = self.fall[at]
        found = self.step[node << 8 | byte] = self.own.get(at << 8 | byte, 0)
        return found

    def has_arc(self, state: int, token: int) -> bool:
        copied, lost, since, left, time = self.copied, self.lost, self.since, self.left, self.time
        while state:
            while time[token] >= since[state]:
                token = left[token]
            if token == lost[state]:
                return False
            state = copied[state]
        return True

    def encode(self, word: bytes) -> list[int]:
        """Ids of the path that spells ``word``."""
        step, ending, table, target = self.step, self.ending, self.table, self.target
        states, last, node = [0], [], 0
        for byte in word:
            known = step.get(node << 8 | byte)
            node = self._next(node, byte) if known is None else known
            for t, size in ending[node]:
                state = states[-size]
                arc = state << 20 | t
                ok = table.get(arc)
                if ok is None:
                    ok = table[arc] = self.has_arc(state, t)
                if ok:
                    break
            states.append(target[t])
            last.append((t, size))
        path, at = [], len(word)
        while at:
            t, size = last[at - 1]
            path.append(t)
            at -= size
        return path[::-1]


class Codec:
    """Whole texts to ids and back, with the words and pieces met so far."""

    def __init__(self, path: str):
        import regex

        vocabulary = Vocabulary(path)
        self.automaton = MergeAutomaton(vocabulary)
        self.split = regex.compile(SPLIT).findall
        self.words: dict[str, bytes] = {}
        self.pieces = PieceCache(self._encode, vocabulary.special)
        size = max(vocabulary.label) + 1
        self.label = [vocabulary.label.get(i, b"") for i in range(size)]

    def _word(self, word: str) -> bytes:
        ids = self.automaton.encode(word.encode("utf-8", "surrogatepass"))
        return np.array(ids, "<u4").tobytes()

    def _encode(self, pieces: list[str]) -> list[bytes]:
        words = self.words
        if len(words) > HELD:
            words.clear()
        if len(self.automaton.table) > 4 * HELD:
            self.automaton.table.clear()
        if len(self.automaton.step) > 4 * HELD:
            self.automaton.step = dict(self.automaton.own)
        out = []
        for piece in pieces:
            parts = []
            for word in self.split(piece):
                packed = words.get(word)
                if packed is None:
                    packed = words[word] = self._word(word)
                parts.append(packed)
            out.append(parts[0] if len(parts) == 1 else b"".join(parts))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.pieces(texts)

    def decode(self, ids) -> str:
        """Bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.label.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One for each worker."""
    return Codec(path)


def encode(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, array<int>. A null or empty text has no ids.
    Rows are encoded one by one; a column ids of the input is replaced."""
    path = vocabulary or default_vocabulary()
    return with_text_columns(docs, "ids array<int>", lambda texts: [[i.astype(np.int32) for i in codec(path).encode(texts)]], text_col)


def decode(encoded: DataFrame, ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids (null: empty)."""
    from pyspark.sql.types import StringType, StructField, StructType

    path = vocabulary or default_vocabulary()
    encoded = encoded.drop("decoded")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [codec(path).decode(ids or ()) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))


def _digests(path: str, texts: list[str]) -> list:
    """Both ways for some texts; their ids are not moved between processes."""
    c = codec(path)
    decimal = _decimal(len(c.label))
    n, ids_sha, text_sha = [], [], []
    for ids in c.encode(texts):
        ids = ids.tolist()
        n.append(len(ids))
        ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
        text_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
    return [n, ids_sha, text_sha]


@lru_cache(maxsize=2)
def _decimal(n: int) -> list[str]:
    return [str(i) for i in range(n)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_vocabulary()
    docs = documents(spark, sf_dir).select("doc_id", "text")
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return with_text_columns(docs, fields, lambda texts: _digests(path, texts)).drop("text")
