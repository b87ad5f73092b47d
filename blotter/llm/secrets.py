"""Secret scan judged by corpus-wide ownership frequency.

Detectors propose candidates in every whole text. The hash of each candidate's
value is aggregated over the corpus: in how many repositories and with how many
owners does it occur? A value seen with more than ``max_owners`` owners, or in
more than ``max_repos`` repositories (of one owner, even), is a widely copied
example; one that stays with its owner and looks random is live.
Candidates of the base kinds (assign, access, hex) are always reported, those
of the wider kinds (pem, token) only if they are live.

A repository is named by owner and repository together. Null is an owner, and
a repository, like any other.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import documents, meets, texts_of, with_text_columns, written

#: In the order in which kinds that start together are listed.
BASE_KINDS = ("assign", "access", "hex")
WIDER_KINDS = ("pem", "token")
MAX_OWNERS = 2
#: A live value may stand in a few repositories of its owner; one in more is a copied example.
MAX_REPOS = 10
#: Bits for each character from which a value looks random.
MIN_ENTROPY = 3.0

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
#: The body ends at the next END line and holds no other BEGIN line; its headers may hold hyphens.
_PEM = re.compile(
    r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----[^-]+(?:-(?!----(?:BEGIN|END) )[^-]*)*"
    r"-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
)
#: Every match of access, hex and token lies in one such run.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
_TOKEN = re.compile(r"[A-Za-z0-9_-]{20,}")

_SPANS = "array<struct<start:long,rank:int,kind:string,end:long,value:long,random:boolean>>"


def entropy(value: str) -> float:
    """Bits for each character, by the value's own character frequencies."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def _looks_random(value: str) -> bool:
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= MIN_ENTROPY


def _value_hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "little", signed=True)


def candidates(text: str) -> list[dict]:
    """All candidates of one text, by start and then kind; positions are code points."""
    found = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    runs = list(_RUN.finditer(text))
    for run in runs:
        a, b = run.span()
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text, a, b) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text, a, b) if len(m[0]) >= 24]
    taken = [(s, e) for s, _, e, _ in found]
    if "-----BEGIN" in text:
        blocks = [(m.start(), 3, m.end(), m[0]) for m in _PEM.finditer(text)]
        taken += [(s, e) for s, _, e, _ in blocks]
        found += blocks
    overlaps = meets(taken)
    for run in runs:
        for m in _TOKEN.finditer(text, *run.span()):
            if _looks_random(m[0]) and not overlaps(*m.span()):
                found.append((m.start(), 4, m.end(), m[0]))
    kinds = (*BASE_KINDS, *WIDER_KINDS)
    return [
        {"start": s, "rank": k, "kind": kinds[k], "end": e, "value": _value_hash(v), "random": k == 3 or _looks_random(v)}
        for s, k, e, v in sorted(found)
    ]


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``, all candidates of each row. Null texts have none."""
    return with_text_columns(docs, f"spans {_SPANS}", lambda texts: [[candidates(t) for t in texts]], text_col)


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_repos, n_owners) of all candidate values in ``found``, with
    the columns owner, repo and spans. A value of any frequency leaves a task
    once for each repository, and the shuffle spreads it over repositories."""
    seen = found.select("owner", "repo", F.explode(F.array_distinct(F.col("spans.value"))).alias("value")).distinct()
    owners = seen.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    return owners.groupBy("value").agg(F.sum("n").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def judged(found: DataFrame, max_owners: int, max_repos: int) -> DataFrame:
    """(row_id, secrets) for the rows of the written table ``found`` that have
    candidates; secrets are their reported spans in order, with the counts of
    their value and ``live``."""
    counts = written(ownership(found), "ownership")
    single = found.select("row_id", F.explode("spans").alias("s")).select("row_id", "s", F.col("s.value").alias("value"))
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos) & F.col("s.random")
    secret = F.struct(
        "s.start", "s.rank", "s.kind", "s.end", "s.value", F.col("n_repos"), F.col("n_owners"), live.alias("live")
    )
    wanted = F.col("s.kind").isin(*BASE_KINDS) | live
    return (
        single.join(counts, "value").filter(wanted).groupBy("row_id")
        .agg(F.array_sort(F.collect_list(secret)).alias("secrets"))
    )


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
    max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS,
) -> DataFrame:
    """A row for each row of ``docs``: id and ``secrets``, an array of (start,
    rank, kind, end, value, n_repos, n_owners, live), empty where there is
    none. Rows are told apart even if they repeat, their repository does not
    count twice. Other columns are not read."""
    picked = docs.select(
        F.col(id_col).alias("id"), F.col(repo_col).alias("repo"), F.col(owner_col).alias("owner"), F.col(text_col).alias("text")
    )
    found = written(with_candidates(picked).drop("text").withColumn("row_id", F.monotonically_increasing_id()), "candidates")
    secrets = judged(found, max_owners, max_repos)
    empty = F.array().cast(secrets.schema["secrets"].dataType)
    return found.join(secrets, "row_id", "left").select(
        F.col("id").alias(id_col), F.coalesce("secrets", empty).alias("secrets")
    )


def redact_live(
    docs: DataFrame, text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
    max_owners: int = MAX_OWNERS, mark: str = "[SECRET]", max_repos: int = MAX_REPOS,
) -> DataFrame:
    """``docs`` with every live secret in the text replaced by ``mark``;
    widely copied examples stay. A column n_chars follows the new text. Only
    rows with candidates are shuffled."""
    names = docs.columns
    at = [f"c{i}" for i in range(len(names))]  # names of any kind and case stay out of the way
    text = at[names.index(text_col)]
    flat = docs.select(
        *[F.col(f"`{c}`").alias(a) for c, a in zip(names, at)], F.col(repo_col).alias("repo"), F.col(owner_col).alias("owner")
    )
    # the texts are scanned and written once; what follows reads the columns it needs
    found = written(with_candidates(flat, text).withColumn("row_id", F.monotonically_increasing_id()), "candidates")
    some = found.filter(F.size("spans") > 0)
    live = judged(some, max_owners, max_repos).select("row_id", F.filter("secrets", lambda s: s.live).alias("live"))
    live = written(live.filter(F.size("live") > 0).select("row_id", F.col("live.start").alias("a"), F.col("live.end").alias("b")), "live")
    marked = some.select(*at, "row_id").join(live, "row_id")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            k = batch.schema.get_field_index(text)
            texts = texts_of(batch.column(k))
            new = [_cut(t, a, b, mark) for t, a, b in zip(texts, batch.column("a").to_pylist(), batch.column("b").to_pylist())]
            columns = [pa.array(new, batch.column(k).type) if i == k else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns[: len(at)], names=at)

    cleaned = marked.select(*at, "a", "b").mapInArrow(cut, marked.select(*at).schema)
    if "n_chars" in names:
        k = at[names.index("n_chars")]
        cleaned = cleaned.withColumn(k, F.length(text).cast(docs.schema["n_chars"].dataType))
    # rows without candidates are never shuffled
    same = found.filter(F.size("spans") == 0).select(*at).unionByName(some.select(*at, "row_id").join(live, "row_id", "left_anti").select(*at))
    return same.unionByName(cleaned).select(*[F.col(a).alias(c) for a, c in zip(at, names)])


def _cut(text: str, starts: list[int], ends: list[int], mark: str) -> str:
    """Spans that overlap are cut as one."""
    out, at = [], 0
    for a, b in sorted(zip(starts, ends)):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` name no repository: each document counts as one, its
    source as the owner."""
    secrets = F.col("secrets")
    base = F.filter(secrets, lambda s: s.kind.isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter(secrets, lambda s: s.kind == kind)).cast("long")
    return find_secrets(documents(spark, sf_dir)).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(secrets).alias("spans"),
        F.size(F.filter(secrets, lambda s: s.live)).cast("long").alias("n_live"),
    )
