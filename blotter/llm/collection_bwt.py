"""Burrows-Wheeler transform and common prefixes of an aligned collection, by columns.

The strings of a collection stand under one another, aligned at a given place.
Round after round, from the last column to the first, one symbol of each string
enters: the suffixes that begin in a column are the symbols of that column in
front of the suffixes of the next one, so a stable sort of the symbols, in the
order of the suffixes behind them, is their order, and the common prefix of
neighbours with the same symbol is one more than the smallest between their
places. Strings may end and begin in any column. Suffixes are compared within a
column and a group alone, as aligned repeats stand in one column.

A round reads order and common prefixes of the column behind from files, from
front to end, and writes those of its own column.
"""

from __future__ import annotations

import tempfile

import numpy as np


class AlignedTransform:
    """``offset`` is the place in each string that is aligned. Common prefixes
    count up to ``most`` (at most 255). The files are the task's own and last
    while the object is in use."""

    def __init__(self, strings: list[bytes], offset: np.ndarray, group: np.ndarray, most: int):
        length = np.array(list(map(len, strings)), np.int64)
        self.first = int(offset.max(initial=0)) - offset
        self.end = self.first + length
        self.offset, self.group, self.most = offset, group.astype(np.int64), most
        #: Symbols by column.
        self.column = np.zeros((int(self.end.max(initial=0)), len(strings)), np.uint8)
        for k, s in enumerate(strings):
            self.column[self.first[k] : self.end[k], k] = np.frombuffer(s, np.uint8)

    def __enter__(self):
        self._files = {(n, t): tempfile.TemporaryFile(buffering=0) for n in ("order", "lcp") for t in (0, 1)}
        return self

    def __exit__(self, *_):
        for f in self._files.values():
            f.close()

    def _read(self, column: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for name, kind in (("order", np.int32), ("lcp", np.uint8)):
            values, file = np.empty(size, kind), self._files[name, column % 2]
            file.seek(0)
            if file.readinto(values) != values.nbytes:
                raise OSError(f"the {name} file is short")
            out.append(values)
        return out[0], out[1]

    def _write(self, column: int, order: np.ndarray, lcp: np.ndarray) -> None:
        for name, values in (("order", order), ("lcp", lcp)):
            file = self._files[name, column % 2]
            file.seek(0)
            if file.write(values) != values.nbytes:
                raise OSError(f"the {name} file was cut short")

    def repeated_starts(self) -> tuple[np.ndarray, np.ndarray]:
        """(string, start) of the suffixes that share ``most`` symbols with
        another of their column and group."""
        none = np.zeros(0, np.int64)
        strings, starts = [none], [none]
        by_end = np.argsort(self.end, kind="stable")
        ends = self.end[by_end]
        size = 0
        for c in range(len(self.column) - 1, -1, -1):
            order, lcp = self._read(c + 1, size) if size else (np.zeros(0, np.int32), np.zeros(0, np.uint8))
            order, lcp = self._without(order, lcp, self.first[order] <= c)
            new = by_end[np.searchsorted(ends, c + 1) : np.searchsorted(ends, c + 1, "right")]
            order, lcp = self._with(order, lcp, new[self.first[new] <= c])
            order, lcp = self._sorted(order, lcp, self.column[c])
            size = len(order)
            self._write(c, order, lcp)
            reach = np.append(lcp >= self.most, False)
            hit = order[reach[:-1] | reach[1:]]
            strings.append(hit)
            starts.append(c - self.first[hit])
        return np.concatenate(strings), np.concatenate(starts)

    def _without(self, order, lcp, kept):
        """Strings that began in the column behind leave; prefixes meet over them."""
        at = np.flatnonzero(kept)
        if len(at) == len(order):
            return order, lcp
        if not len(at):
            return order[:0], lcp[:0]
        low = np.minimum.reduceat(lcp[: at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
        return order[at], low

    def _with(self, order, lcp, new):
        """Strings that end in this column enter, before all others of their group."""
        if not len(new):
            return order, lcp
        order = np.concatenate([new.astype(np.int32), order])
        lcp = np.concatenate([np.zeros(len(new), np.uint8), lcp])
        by_group = np.argsort(self.group[order], kind="stable")
        return order[by_group], lcp[by_group]

    def _sorted(self, order, lcp, symbols):
        """``order`` after the symbols in front; prefixes do not reach over groups."""
        key = self.group[order] << 8 | symbols[order]
        by_key = np.argsort(key, kind="stable")
        key = key[by_key]
        out = np.zeros(len(order), np.uint8)
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        a, b = by_key[same - 1], by_key[same]
        value = lcp[b].astype(np.int64)
        apart = np.flatnonzero(b - a > 1)
        if len(apart):
            apart = apart[np.argsort(a[apart])]
            span = np.empty(2 * len(apart), np.int64)
            span[::2], span[1::2] = a[apart] + 1, b[apart] + 1
            value[apart] = np.minimum.reduceat(np.append(lcp, np.uint8(0)), span)[::2]
        out[same] = np.minimum(value + 1, self.most)
        return order[by_key], out
