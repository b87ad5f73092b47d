"""Licence scan by canonical digests, DataFrame operations only.

A text is brought into canonical form: ASCII letters in lower case, lines of
copyright holders left out, equivalent spellings made one, punctuation and white
space one space. The digests of the whole text, of its paragraphs and of its
lines are joined with those of known licence texts and notices, so a licence is
found where one of these is a licence from end to end, whoever holds the rights
and however it is set. A licence of several paragraphs that stands inside a larger
text with its blank lines is none of these and is not found.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache, reduce
from importlib import resources
from itertools import chain, product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import documents, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spellings that mean the same in licence texts (fixed values), replaced in this order.
EQUAL_SPELLINGS = (
    ("licence", "license"),
    ("licencing", "licensing"),
    ("sub-licens", "sublicens"),
    ("sub licens", "sublicens"),
    ("non-commercial", "noncommercial"),
    ("non-infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("copyright holder", "copyright owner"),
    ("http://", "https://"),
    ("&", " and "),
)
_HOLDERS = r"(?m)^[ \t>*#/;-]*(copyright [(0-9]|copyright ©|copyright:|\(c\)|©)[^\n]*$"
# Classes under one repetition only: a repeated group is a recursion a repeat in
# Java's patterns, and some thousand marks or blank lines would end its stack.
_MARKS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F“”‘’–—•©]+"
_PARAGRAPH = r"\n[ \n]*\n"  # of canonical lines, where no two blanks meet

#: A phrase of EQUAL_SPELLINGS that some settings break across lines, where it keeps its spelling.
_HOLDER_BREAK = r"(?i)(?<=copyright)[ \n]+(?=holder)"
_FEW_BREAKS = 3


def _settings(text: str) -> list[str]:
    """``text`` with and without a line break at each of a few "copyright
    holder"; a text with more of them as it is set in the file and without any."""
    parts = re.split(_HOLDER_BREAK, text)
    if len(parts) - 1 > _FEW_BREAKS:
        return [text, " ".join(parts)]
    return ["".join(chain(*zip(parts, (*gaps, "")))) for gaps in product(" \n", repeat=len(parts) - 1)]


def load_known(content: str) -> tuple[tuple[str, str], ...]:
    """(license, text) pairs of a file like known_licenses.json: each of
    ``texts`` in its settings, with each of the ``swaps`` in place of the first
    one, below each of the ``titles`` and ``rights`` lines; then the notices."""
    data = json.loads(content)
    known = []
    for entry in data["texts"]:
        swaps = entry.get("swaps", [""])
        for text, swap in product(entry["texts"], swaps):
            swapped = text.replace(swaps[0], swap) if swap else text
            for body, title, rights in product(_settings(swapped), entry["titles"], entry.get("rights", [""])):
                known.append((entry["license"], "\n\n".join(p for p in (title, rights, body) if p)))
    return tuple(dict.fromkeys([*known, *map(tuple, data["notices"])]))


#: Texts of licences, with the usual titles, and the notices that stand for them.
KNOWN = load_known(resources.files("blotter.llm").joinpath("known_licenses.json").read_text("utf-8"))


def canonical_lines(text: Column) -> Column:
    """Canonical form that keeps line feeds. Null counts as empty."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    low = F.regexp_replace(low, _HOLDERS, "")
    low = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), EQUAL_SPELLINGS, low)
    return F.regexp_replace(low, _MARKS, " ")


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \n]+", " "))


@lru_cache(maxsize=1)
def _default_digests(application: str) -> tuple[tuple[str, str], ...]:
    return tuple((r.digest, r.license) for r in _digests(SparkSession.getActiveSession(), KNOWN).collect())


def _digests(spark: SparkSession, known) -> DataFrame:
    table = spark.createDataFrame(list(known), "license string, text string")
    return (
        table.select(F.sha2(one_line(canonical_lines(F.col("text"))), 256).alias("digest"), "license")
        .groupBy("digest").agg(F.min("license").alias("license"))
    )


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license); a text that is known by several names has the smallest.
    The digests of ``KNOWN`` (a fixed table) are made once in an application."""
    if known is not KNOWN or SparkSession.getActiveSession() is None:
        return _digests(spark, known)
    return spark.createDataFrame(list(_default_digests(spark.sparkContext.applicationId)), "digest string, license string")


def find_licenses(
    docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row for each row of ``docs``: id, text_digest (of the canonical text),
    text_license (of the whole text, or null) and licenses (sorted, without
    repeats, of the text, its paragraphs and its lines).

    ``known`` has the columns digest and license, and may be of any size: the
    join is left to Spark. The texts are read once, their digests are written;
    only parts that are known licences are grouped and joined back. Null and
    empty texts have no licence. Repeated rows get equal answers. A text of one
    character a million times, or of that many blank lines, is as any other.
    Other columns are not read.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    known = known.select(F.unhex("digest").alias("digest"), "license")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"), F.xxhash64(F.lit(5), F.col(id_col), text).alias("key2"),
        canonical_lines(F.col(text_col)).alias("lines"),
    )
    whole = lines.withColumn("whole", one_line(F.col("lines")))
    # a paragraph of one line is among the lines; a canonical line has single spaces
    paragraphs = F.transform(F.filter(F.split("lines", _PARAGRAPH), lambda p: p.contains("\n")), one_line)
    # the sets are made by functions that take the whole text once: a lambda would form it again for each part
    others = F.concat(paragraphs, F.transform(F.split("lines", "\n"), lambda p: F.trim(p)))
    parts = F.concat(F.array("whole"), F.array_except(others, F.array(F.col("whole"), F.lit(""))))
    digests = written(whole.select("id", "key", "key2", F.transform(parts, lambda p: F.unhex(F.sha2(p, 256))).alias("digests")), "digests")
    each = digests.select("id", "key", "key2", F.posexplode("digests").alias("at", "digest"))
    found = each.join(known, "digest").groupBy("id", "key", "key2").agg(
        F.max(F.when(F.col("at") == 0, F.col("license"))).alias("text_license"), F.array_sort(F.collect_set("license")).alias("licenses")
    )
    rows = digests.select("id", "key", "key2", F.lower(F.hex(F.col("digests")[0])).alias("text_digest"))
    same = rows["id"].eqNullSafe(found["id"]) & (rows["key"] == found["key"]) & (rows["key2"] == found["key2"])
    licenses = F.coalesce(found["licenses"], F.array().cast("array<string>"))
    return rows.join(found, same, "left").select(rows["id"].alias(id_col), "text_digest", "text_license", licenses.alias("licenses"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(documents(spark, sf_dir)).select(
        "doc_id", "text_digest", "text_license", F.array_join("licenses", ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_licenses"),
    )


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    out = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    out = f"regexp_replace({out}, {_sql_text(_HOLDERS)}, '', 'g')"
    for a, b in EQUAL_SPELLINGS:
        out = f"replace({out}, {_sql_text(a)}, {_sql_text(b)})"
    return f"regexp_replace({out}, {_sql_text(_MARKS)}, ' ', 'g')"


def _sql_line(text: str) -> str:
    return rf"trim(regexp_replace({text}, '[ \n]+', ' ', 'g'), ' ')"


SQL = rf"""
WITH known AS (
    SELECT sha256({_sql_line(_sql_canonical('t'))}) AS digest, min(license) AS license
    FROM (VALUES {', '.join(f'({_sql_text(n)}, {_sql_text(t)})' for n, t in KNOWN)}) k(license, t) GROUP BY 1
),
lines AS (SELECT doc_id, {_sql_canonical('text')} AS c FROM documents),
parts AS (
    SELECT doc_id, unnest(list_concat([c], string_split_regex(c, '{_PARAGRAPH}'), string_split(c, chr(10)))) AS p FROM lines
),
hits AS (
    SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(DISTINCT license) AS n
    FROM parts JOIN known ON sha256({_sql_line('p')}) = digest WHERE {_sql_line('p')} <> '' GROUP BY 1
)
SELECT l.doc_id, sha256({_sql_line('c')}) AS text_digest, k.license AS text_license,
       coalesce(h.licenses, '') AS licenses, coalesce(h.n, 0) AS n_licenses
FROM lines l LEFT JOIN known k ON sha256({_sql_line('c')}) = k.digest LEFT JOIN hits h ON l.doc_id = h.doc_id
"""
