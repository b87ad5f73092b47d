"""Quality rules on repetition, from a suffix array of each text's words.

For a batch of texts, prefix doubling sorts all suffixes of their words; the
text's number is part of each word, so that suffixes of different texts never
share a prefix. The longest common prefix of neighbours in that order gives,
for each word, the longest substring that starts there and occurs again in the
text, that is the deepest common-prefix interval that holds the suffix. The
union of the spans of at least ``min_words`` words and the longest of them are
held against limits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import Words, documents, mix, with_text_columns

#: Repeated substrings count from so many words.
MIN_WORDS = 10
#: A text may have so large a share of its words in them,
MAX_COVERED = 0.30
#: and none of more words than this.
MAX_LONGEST = 120
_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, repeat_covered_words long, longest_repeat_words long"
)


def longest_repeats(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word, the number of words of the longest substring that starts
    there and also starts elsewhere in its text (0: not even the word does)."""
    n = len(hashes)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    value = hashes ^ mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(value, kind="stable")
    new = np.concatenate([[True], value[order][1:] != value[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [rank], 1
    while step < n:
        size = np.bincount(rank, minlength=n)
        active = np.flatnonzero(size[rank] > 1)
        if not len(active):
            break
        after = np.where(active + step < n, rank[np.minimum(active + step, n - 1)], -1)
        own = rank[active]
        order = np.lexsort((after, own))
        own, after, active = own[order], after[order], active[order]
        first = np.concatenate([[True], own[1:] != own[:-1]])
        new = first | np.concatenate([[True], after[1:] != after[:-1]])
        at = np.arange(len(active))
        within = at - np.maximum.accumulate(np.where(first, at, 0))
        last_new = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = own + within[last_new]
        levels.append(rank)
        step *= 2
    suffixes = np.argsort(rank, kind="stable")
    pair = np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]])
    a, b = suffixes[pair], suffixes[pair + 1]
    common = np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        fits = np.maximum(i, j) < n
        same = fits & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        common += same.astype(np.int64) << k
    np.maximum.at(longest, a, common)
    np.maximum.at(longest, b, common)
    return longest


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a span."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def _by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def _repeated_lines(text: str) -> int:
    seen, count = set(), 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            count += line in seen
            seen.add(line)
    return count


def judge(
    texts: list[str], min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST
) -> list:
    """The columns of ``_FIELDS`` for some texts."""
    words = Words(texts)
    n = len(words.hash)
    n_words = np.diff(words.first)
    longest = longest_repeats(words.hash, words.doc)

    three = np.flatnonzero(longest >= 3)
    n_repeat = _by_text(_covered(three, np.full(len(three), 3), n), words.first)
    long = np.flatnonzero(longest >= min_words)
    covered = _by_text(_covered(long, longest[long], n), words.first)
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, words.doc[long], longest[long])
    chars = [len(t) - sum(map(t.count, _SPACES)) for t in texts]
    symbols = [sum(map(t.count, _SYMBOLS)) for t in texts]
    lines = [_repeated_lines(t) for t in texts]
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    kept = ~failed & (covered <= max_covered * n_words) & (most <= max_longest)
    return [n_words, chars, symbols, lines, n_repeat, failed, kept, covered, most]


def repetition_rules(
    docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS,
    max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """``docs`` with the counts and the verdict of every whole text.

    A null or empty text has no words, so it fails. The columns of the input
    come first, but for those that are called like new ones. Rows are judged one by one: repeated rows get equal answers.
    """
    return with_text_columns(docs, _FIELDS, lambda texts: judge(texts, min_words, max_covered, max_longest), text_col)


def drop_rejected(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs``, with their columns, that the rules keep."""
    names = docs.columns
    at = [f"c{i}" for i in range(len(names))]  # names of any kind and case stay out of the way
    flat = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(names, at)])
    judged = repetition_rules(flat, at[names.index(text_col)], **limits).filter("kept")
    return judged.select(*[F.col(a).alias(c) for a, c in zip(at, names)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
