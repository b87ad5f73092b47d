from __future__ import annotations

import pytest

#: Columns of documents and some that are called like results and inner columns.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, spans string, ids string, "
    "component_id long, key string, id string, row string, piece int, secrets string, personal string, sha string, "
    "block int, owner string, repo string, n_words string, digest string, text_key string"
)
WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


#: Null ids and texts, empty texts, white space alone, ties, repeated rows, a very long text.
EDGES = [
    (None, None), (None, prose(1, 90)), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, prose(1, 90)), (6, prose(1, 90)),
    (6, prose(1, 90)), (7, prose(2, 80)), (8, prose(2, 80).replace(" ", "  \n")), (9, prose(3, 30_000)), (10, "é中 \U0001f600 İ"),
    (11, prose(2, 80) + " tail"), (12, "x" * 5000), (13, 'token = "0123456789abcdef0123456789abcdef"'),
]


def table(spark, rows):
    full = [(i, t, "en", None if i == 7 else f"src{(i or 0) % 3}", None if t is None else len(t), *[None] * 17) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def edges(spark):
    return table(spark, EDGES).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [])
