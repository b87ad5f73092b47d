"""Top-n per group and top/bottom-k."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.operators import top_and_bottom_n, top_n_per_group
from tests.conftest import rows


def test_top_n_row_number_breaks_ties(spark):
    df = spark.createDataFrame(
        [(2020, 1, 5), (2020, 2, 3), (2020, 3, 3), (2020, 4, 3), (2021, 1, 1)], "y int, m int, c long"
    )
    out = top_n_per_group(df, ["y"], [F.desc("c"), F.asc("m")], 3, rank_col="r")
    assert rows(out) == [(2020, 1, 5, 1), (2020, 2, 3, 2), (2020, 3, 3, 3), (2021, 1, 1, 1)]


def test_top_n_rank_keeps_ties(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 3), (1, "c", 3), (1, "d", 1)], "g int, k string, v int")
    out = top_n_per_group(df, ["g"], [F.desc("v")], 2, rank="rank", rank_col="r")
    assert rows(out, "k", "r") == [("a", 1), ("b", 2), ("c", 2)]


def test_top_n_plan_uses_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    out = top_n_per_group(df, ["g"], [F.desc("v")], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.count() == 21


def test_top_and_bottom_union_all_and_nulls(spark):
    df = spark.createDataFrame([("a", 10), ("b", 20), ("c", None), ("d", 5)], "k string, v int")
    out = top_and_bottom_n(df, "v", 3, tie_break=["k"])
    # three non-null rows: each is in both lists (UNION ALL keeps both copies)
    assert rows(out, "k") == [("a",), ("a",), ("b",), ("b",), ("d",), ("d",)]
    assert rows(top_and_bottom_n(df, "v", 3, tie_break=["k"], distinct_rows=True), "k") == [("a",), ("b",), ("d",)]


def test_top_and_bottom_tie_break(spark):
    df = spark.createDataFrame([("z", 1), ("y", 1), ("x", 1), ("w", 9)], "k string, v int")
    out = top_and_bottom_n(df, "v", 1, tie_break=["k"])
    assert rows(out, "k") == [("w",), ("x",)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(-5, 5)), min_size=1, max_size=80), st.integers(1, 4))
def test_top_n_matches_brute_force(spark, pairs, n):
    rows_in = [(g, v, i) for i, (g, v) in enumerate(pairs)]
    df = spark.createDataFrame(rows_in, "g int, v int, k int")
    got = rows(top_n_per_group(df, ["g"], [F.desc("v"), F.asc("k")], n, rank_col="r"))
    want = []
    for g in sorted({g for g, _, _ in rows_in}):
        ranked = sorted((r for r in rows_in if r[0] == g), key=lambda r: (-r[1], r[2]))[:n]
        want += [(*r, i + 1) for i, r in enumerate(ranked)]
    assert got == sorted(want)
    tb = rows(top_and_bottom_n(df, "v", n, tie_break=["k"]), "k")
    top = sorted(rows_in, key=lambda r: (-r[1], r[2]))[:n]
    bottom = sorted(rows_in, key=lambda r: (r[1], r[2]))[:n]
    assert tb == sorted((r[2],) for r in top + bottom)
