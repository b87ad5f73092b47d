"""Byte-level BPE vocabularies and the splitting of texts for them.

A text is cut where no word of the pre-split pattern can reach over: around
white space, but for the space that a word begins with, and after a letter that
punctuation follows. The pieces can thus be encoded one by one, and each
distinct piece once. They are found and told apart for a whole batch with numpy.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pandas as pd

from blotter.llm.common import LOWER, SPACE, span_hashes

#: The fixed pre-split pattern of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space that is not in ``SPACE``; texts with any are one piece.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_POINT = np.zeros(256, bool)
_POINT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: Bytes of distinct pieces held at once by a worker, each counted with its place in the table.
HELD_BYTES, _ENTRY = 32_000_000, 180


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def printable_bytes() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: a
    printable Latin-1 byte as itself, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """``label[id]`` in bytes, ``merges`` as (left id, right id, id) by rank, ``special`` (text to id)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or model["dropout"]:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        byte = printable_bytes()
        ids = model["vocab"]
        self.label = {i: bytes(byte[c] for c in word) for word, i in ids.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self.special = {}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError(f"added token {t['content']!r} strips its neighbours")
            self.special[t["content"]] = t["id"]
            self.label[t["id"]] = t["content"].encode()


def pieces(data: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the pieces of texts that stand in ``data`` with a line
    feed before each and after the last, at ``edge``."""
    space = SPACE[data]
    inner = space[1:] & space[:-1]  # white space before and at 1, 2, ...
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = space[1:] & ~space[:-1]
    word = ~space[1:] & space[:-1]  # a word begins after white space
    cut[1:-1] |= word & (data[:-1] != 32)
    at = np.flatnonzero(word)  # of the last white space before it
    cut[at[inner[np.maximum(at - 1, 0)]]] = True
    cut[1:-1] |= _LETTER[data[:-1]] & _POINT[data[1:]]
    cut[edge] = cut[edge + 1] = True
    start = np.flatnonzero(cut[:-1])
    end = np.append(start[1:], len(data))
    is_edge = np.zeros(len(data), bool)
    is_edge[edge] = True
    kept = ~is_edge[start]
    return start[kept], end[kept]


class PieceCache:
    """Encodes texts piece by piece. ``encode`` turns a list of strings into a
    list of packed ids (32 bits, little-endian); ``special`` maps strings that
    are tokens of their own, wherever they stand, to ids. ``split`` finds the
    pieces, in texts whose letters A-Z are first made small if ``lower``."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], special: dict[str, int], split=pieces, lower: bool = False):
        self.encode, self.split, self.lower = encode, split, lower
        self.known: dict[int, bytes] = {}
        self.held = 0
        self.special = special
        longest_first = sorted(special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None

    def forget(self) -> None:
        """Lets the pieces go, at the end of a task: the worker lives on, maybe for another stage."""
        self.known.clear()
        self.held = 0

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        plain = [not self._peculiar(t) for t in texts]
        found = iter(self._batch([t for t, p in zip(texts, plain) if p]))
        return [next(found) if p else self._slow(t) for t, p in zip(texts, plain)]

    def _peculiar(self, text: str) -> bool:
        return any(s in text for s in self.special) or _ODD.search(text) is not None

    def _slow(self, text: str) -> np.ndarray:
        out = []
        for part in self.split_special.split(text) if self.split_special else [text]:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4"))
            elif part:
                out.append(np.frombuffer(self.encode([part])[0], "<u4"))
        return np.concatenate(out) if out else np.zeros(0, "<u4")

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        blobs = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join([b"", *blobs, b""]), np.uint8)
        data = LOWER[data] if self.lower else data
        edge = np.cumsum([0, *(len(b) + 1 for b in blobs)])
        start, end = self.split(data, edge)
        if not len(start):
            return [np.zeros(0, "<u4") for _ in texts]
        code, distinct = pd.factorize(span_hashes(data, start, end))
        one = np.empty(len(distinct), np.int64)
        one[code[::-1]] = np.arange(len(code))[::-1]
        if self.held > HELD_BYTES:
            self.forget()
        keys = distinct.tolist()
        packed = list(map(self.known.get, keys))
        new = [k for k, p in enumerate(packed) if p is None]
        raw = data.tobytes()
        strings = [raw[start[i] : end[i]].decode("utf-8", "surrogatepass") for i in one[new]]
        for k, p in zip(new, self.encode(strings) if new else ()):
            packed[k] = self.known[keys[k]] = p
            self.held += len(p) + _ENTRY
        ids = np.frombuffer(b"".join(packed), "<u4")
        length = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        first = np.cumsum(length) - length
        each = length[code]
        stop = np.cumsum(each)
        out = ids[np.repeat(first[code] - (stop - each), each) + np.arange(stop[-1])]
        at = np.concatenate([[0], stop])[np.searchsorted(start, edge)]
        return [out[a:b] for a, b in zip(at, at[1:])]
