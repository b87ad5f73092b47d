"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns are the base. The field reads runs of words that hold a digit or
an at sign. Every span of up to ``MAX_WORDS`` of them is a candidate segment of
each type, scored by features of the whole span; dynamic programming over the
segmentations of a run chooses boundaries and types jointly. What it finds
beside the base spans is added.

The weights are learned here, by the gradient of the conditional likelihood,
from ``SAMPLE_ROWS`` rows (those with the smallest hash among the rows with a
digit or an at sign), labelled by the base patterns. Phone numbers are also
shown without their country code, so that the national form is learned, and
spoilt copies of all spans as outside.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import documents, meets, with_text_columns

KINDS = ("email", "ip", "card", "phone")
#: Label 0 is a word outside; outside segments have one word.
LABELS = ("outside", *KINDS)
MAX_WORDS = 5
#: Bounds of the labelled sample that the field is fitted on: rows, runs of a row (the first ones), words of a run.
SAMPLE_ROWS, SAMPLE_RUNS, SAMPLE_WORDS = 400, 200, 50
ROUNDS = 8
RATE = 0.3
DECAY = 1e-4
#: Log-odds by which a span must beat its words being outside.
MARGIN = 1.0
SEED = 4

# The patterns take a time in proportion to the text: an address is looked for
# from its at sign on, and numbers begin where no digit is before them.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HOT = re.compile(r"[0-9@]")
_SPACES = frozenset(" \t\n\v\f\r")
_WORD_BEFORE = re.compile(r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*\Z")
_SPANS = "array<struct<rank:int,kind:string,start:long,end:long,base:boolean>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _addresses(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > free and text[a - 1] in _LOCAL:
            a -= 1
        host = _HOST.match(text, at + 1) if a < at else None
        if host:
            out.append((a, host.end()))
            free = host.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind and start."""
    out = []
    if "@" in text:
        out += [(0, *span) for span in _addresses(text)]
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


# ------------------------------------------------------------------ segments


def runs(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring words with a digit or an at sign, as (start, end) of the words."""
    out: list[list[tuple[int, int]]] = []
    at, n = 0, len(text)
    while m := _HOT.search(text, at):
        a = m.start()
        while a > at and text[a - 1] not in _SPACES:
            a -= 1
        b = m.end()
        while b < n and text[b] not in _SPACES:
            b += 1
        if out and a - out[-1][-1][1] == 1 and text[a - 1] == " ":
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
        at = b
    return out


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """Without punctuation around it; a plus or a bracket may begin a span."""
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


def _shape(s: str) -> str:
    out = []
    for c in s:
        k = "9" if c in "0123456789" else "a" if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:24])


def features(text: str, a: int, b: int, words: int, before: str) -> list[str]:
    """Of a whole span and the word before it."""
    s, digits = text[a:b], _digits(text[a:b])
    out = [
        "bias", f"words={words}", f"shape={_shape(s)}", f"words={words} digits={min(len(digits), 24)}", f"digits={min(len(digits), 24)}",
        f"first={s[:1] if not s[:1].isalnum() else 'x'}", f"others={''.join(sorted(set(re.sub('[A-Za-z0-9]', '', s))))[:8]}",
        f"before={before.lower()[-12:]}",
    ]
    if "@" in s:
        name, _, host = s.partition("@")
        out.append(f"address={bool(name) and '.' in host and '@' not in host}")
    if 12 < len(digits) < 20 and len(digits) + s.count(" ") + s.count("-") == len(s):
        out.append(f"luhn={luhn(digits)}")
    if s.count(".") == 3 and len(digits) + 3 == len(s):
        out.append(f"octets={all(p and int(p) <= 255 for p in s.split('.') if len(p) < 9)}")
    groups = [len(g) for g in re.findall("[0-9]+", s)]
    return [*out, f"groups={'-'.join(map(str, groups[-6:]))}"]


class Run:
    """A run with the features of its candidate segments: ``segments[j]`` are
    those that end before word j, as (first word, span, features)."""

    def __init__(self, text: str, words: list[tuple[int, int]]):
        before = _WORD_BEFORE.search(text, max(0, words[0][0] - 40), words[0][0])
        context = [before[1] if before else "", *(text[a:b] for a, b in words)]
        self.n = len(words)
        self.segments = []
        for j in range(1, self.n + 1):
            ending = []
            for i in range(max(0, j - MAX_WORDS), j):
                a, b = trimmed(text, words[i][0], words[j - 1][1])
                ending.append((i, (a, b), features(text, a, b, j - i, context[i])))
            self.segments.append(ending)


# ------------------------------------------------------------------ field


class Field:
    """Weights of features and of label transitions (the last row: at the start)."""

    def __init__(self):
        k = len(LABELS)
        self.weight: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(k))
        self.step = np.zeros((k + 1, k))

    def __getstate__(self):
        return {"weight": dict(self.weight), "step": self.step}

    def __setstate__(self, state):
        self.__init__()
        self.weight.update(state["weight"])
        self.step = state["step"]

    def _score(self, i: int, j: int, feats: list[str]) -> np.ndarray:
        out = np.zeros(len(LABELS))
        for f in feats:
            w = self.weight.get(f)
            if w is not None:
                out += w
        if j - i > 1:
            out[0] = -math.inf
        return out

    def segment(self, run: Run) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the best segmentation's entities."""
        best = [np.full(len(LABELS) + 1, -math.inf) for _ in range(run.n + 1)]
        best[0][-1] = 0.0
        back: list[dict] = [{} for _ in range(run.n + 1)]
        for j, ending in enumerate(run.segments, 1):
            for i, span, feats in ending:
                score = self._score(i, j, feats)
                score[1:] -= MARGIN
                total = best[i][:, None] + self.step + score
                for y in range(len(LABELS)):
                    p = int(np.argmax(total[:, y]))
                    if total[p, y] > best[j][y]:
                        best[j][y] = total[p, y]
                        back[j][y] = (i, p, span)
        out, j, y = [], run.n, int(np.argmax(best[run.n]))
        while j:
            i, p, span = back[j][y]
            if y:
                out.append((y - 1, *span))
            j, y = i, p
        return out[::-1]

    def learn(self, examples: list[tuple[Run, dict[tuple[int, int], int]]]) -> None:
        """Examples: runs and, by (first word, end word), the labels of their segments."""
        rng = np.random.default_rng(SEED)
        seen: dict[str, np.ndarray] = defaultdict(lambda: np.full(len(LABELS), 1e-6))
        seen_step = np.full_like(self.step, 1e-6)
        for _ in range(ROUNDS):
            for k in rng.permutation(len(examples)):
                slope, slope_step = self._gradient(*examples[k])
                for f, g in slope.items():
                    g -= DECAY * self.weight[f]
                    seen[f] += g * g
                    self.weight[f] += RATE * g / np.sqrt(seen[f])
                seen_step += slope_step**2
                self.step += RATE * slope_step / np.sqrt(seen_step)

    def _gradient(self, run: Run, gold: dict[tuple[int, int], int]):
        """Of the log-likelihood: features of the gold segments less those expected."""
        n, k = run.n, len(LABELS)
        scores = {(i, j): self._score(i, j, f) for j, e in enumerate(run.segments, 1) for i, _, f in e}
        ahead = np.full((n + 1, k + 1), -math.inf)
        ahead[0, -1] = 0.0
        entry = {}
        for j, ending in enumerate(run.segments, 1):
            for i, _, _ in ending:
                entry[i, j] = np.logaddexp.reduce(ahead[i][:, None] + self.step, axis=0) + scores[i, j]
                ahead[j, :k] = np.logaddexp(ahead[j, :k], entry[i, j])
        behind = np.full((n + 1, k), -math.inf)
        behind[n] = 0.0
        for j in range(n, 0, -1):
            for i, _, _ in run.segments[j - 1]:
                if i:
                    onward = np.logaddexp.reduce(self.step[:k] + scores[i, j] + behind[j], axis=1)
                    behind[i] = np.logaddexp(behind[i], onward)
        whole = np.logaddexp.reduce(ahead[n, :k])
        slope: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(k))
        slope_step = np.zeros_like(self.step)
        for j, ending in enumerate(run.segments, 1):
            for i, _, feats in ending:
                g = -np.exp(entry[i, j] + behind[j] - whole)
                slope_step -= np.exp(ahead[i][:, None] + self.step + scores[i, j] + behind[j] - whole)
                if (i, j) in gold:
                    g[gold[i, j]] += 1
                for f in feats:
                    slope[f] += g
        last = k
        for (_, _), y in sorted(gold.items()):
            slope_step[last, y] += 1
            last = y
        return slope, slope_step


def examples(text: str) -> list[tuple[Run, dict]]:
    """Runs of a text labelled by the base patterns. A run in which a base span
    is no candidate segment is left out."""
    spans = {(a, b): kind + 1 for kind, a, b in base_spans(text)}
    out = []
    for words in runs(text):
        run = Run(text, words)
        inside = {s for s in spans if words[0][0] <= s[0] and s[1] <= words[-1][1]}
        gold, at = {}, 0
        found = {(i, j): spans[span] for j, e in enumerate(run.segments, 1) for i, span, _ in e if span in inside}
        for i, j in sorted(found):
            if i >= at:
                gold.update({(x, x + 1): 0 for x in range(at, i)})
                gold[i, j] = found[i, j]
                at = j
        gold.update({(x, x + 1): 0 for x in range(at, run.n)})
        if sum(map(bool, gold.values())) == len(inside):
            out.append((run, gold))
    return out


_COUNTRY = re.compile(r"\+[0-9]{1,3}[ .-](?=[(0-9])")


def national(text: str) -> list[tuple[Run, dict]]:
    """The phone numbers of a text as runs of their own, without country code."""
    out = []
    for kind, a, b in base_spans(text):
        if KINDS[kind] == "phone" and (m := _COUNTRY.match(text, a, b)):
            before = _WORD_BEFORE.search(text, max(0, a - 40), a)
            alone = f"{before[1] if before else ''} {text[m.end():b]}"
            words = runs(alone)
            if words and len(words[-1]) <= MAX_WORDS:
                run = Run(alone, words[-1])
                out.append((run, {(0, run.n): KINDS.index("phone") + 1}))
    return out


def spoilt(text: str) -> list[tuple[Run, dict]]:
    """Runs that look like the base spans of a text and are none: other
    separators, half of the span, another last digit, one letter for the at sign."""
    out = []
    for _, a, b in base_spans(text):
        s = text[a:b]
        before = _WORD_BEFORE.search(text, max(0, a - 40), a)
        other = s[:-1] + str((int(s[-1]) + 1) % 10) if s[-1].isdigit() else s[:-1]
        for bad in (re.sub("[^A-Za-z0-9]+", "-", s.strip("+")), re.sub("[^A-Za-z0-9]+", "/", s.strip("+")), s[: len(s) // 2], s[len(s) // 2 :], s.replace("@", "a1"), other):
            alone = f"{before[1] if before else ''} {bad}"
            words = runs(alone)
            if words and len(words[-1]) <= MAX_WORDS and not base_spans(alone):
                run = Run(alone, words[-1])
                out.append((run, {(x, x + 1): 0 for x in range(run.n)}))
    return out


def fit(texts: list[str]) -> Field:
    field = Field()
    field.learn([e for make in (examples, national, spoilt) for t in texts for e in make(t)])
    return field


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> Field:
    """Fitted on the sample; the driver gets the surroundings of its digits and
    at signs alone. The hashes are ranked first, so that no task gathers texts
    of rows that are not in the sample."""
    text = F.col(text_col)
    hashed = docs.filter(text.rlike("[0-9@]")).select(
        F.xxhash64(F.col(id_col).cast("string"), text, F.lit(SEED)).alias("h"), text.alias("text")
    )
    last = hashed.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    sample = hashed.filter(F.col("h") <= F.lit(last if last is not None else 0)).orderBy("h").limit(rows)
    short = with_text_columns(sample, "near array<string>", lambda texts: [[_surroundings(t) for t in texts]])
    found = [r.near for r in short.select("h", "near").orderBy("h").collect()]
    return fit([t for near in found for t in near])


def _surroundings(text: str) -> list[str]:
    """Runs of a sampled text, within the sample's bounds, each with some characters around it."""
    return [text[max(0, w[0][0] - 40) : w[-1][1] + 1] for w in runs(text)[:SAMPLE_RUNS] if len(w) <= SAMPLE_WORDS]


def all_spans(text: str, field: Field) -> list[dict]:
    """Base spans and those that the field adds, by kind and start."""
    spans = [(kind, a, b, True) for kind, a, b in base_spans(text)]
    overlaps = meets([(a, b) for _, a, b, _ in spans])
    for words in runs(text):
        for kind, a, b in field.segment(Run(text, words)):
            if not overlaps(a, b):
                spans.append((kind, a, b, False))
    return [{"rank": k, "kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in sorted(spans)]


def find_personal_data(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with ``personal``, the spans of each whole text by kind and
    start, in code points. Null and empty texts have none; rows are read one by
    one, repeated ones get equal answers. A column personal of the input is replaced."""
    return with_text_columns(docs, f"personal {_SPANS}", lambda texts: [[all_spans(t, field) for t in texts]], text_col)


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    spans = F.col("personal")
    base = F.filter(spans, lambda s: s.base)
    count = lambda kind: F.size(F.filter(base, lambda s: s.kind == kind)).cast("long")
    return find_personal_data(docs, train(docs)).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(spans).alias("spans"),
        (F.size(spans) - F.size(base)).cast("long").alias("n_added"),
    )
