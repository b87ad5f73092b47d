"""Filters of bounded size, DISTINCT by hash, joins on nearly equal numbers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from blotter.operators import join_near, key_filter, passing, row_hash, with_verdict
from blotter.sources import deduplicate
from tests.conftest import rows
from tests.planutil import executed_final_plan


@pytest.mark.parametrize("slots", [4, 1 << 12])
def test_every_key_that_was_put_in_passes(spark, slots):
    inside = spark.range(0, 3000, 3).select(row_hash([F.col("id")]).alias("h"))
    table = key_filter(inside, slots=slots)
    assert table.count() <= slots
    got = {r.id for r in passing(spark.range(3000), row_hash([F.col("id")]), table, slots).collect()}
    assert set(range(0, 3000, 3)) <= got
    assert slots < 100 or len(got) < 1100
    told = with_verdict(spark.range(3000), row_hash([F.col("id")]), table, "may", slots)
    assert told.count() == 3000 and {r.id for r in told.filter("may").collect()} == got


def test_nulls_are_told_apart(spark):
    df = spark.sql("SELECT * FROM VALUES (null, 'a'), ('a', null), (null, null), ('', 'a') AS t(x, y)")
    assert df.select(row_hash([F.col("x"), F.col("y")])).distinct().count() == 4


@pytest.mark.parametrize("slots", [2, None])
def test_distinct_by_hash_is_distinct(spark, monkeypatch, slots):
    import importlib

    K = importlib.import_module("blotter.operators.key_filter")
    if slots:
        # a filter so full that nearly every row goes the long way
        monkeypatch.setattr(K.key_filter, "__defaults__", ("h", slots))
        monkeypatch.setattr(K.with_verdict, "__defaults__", (slots,))
    rng = random.Random(1)
    made = [(rng.choice([None, "a", "b"]), rng.choice([None, 1.5, float("nan"), -0.0, 0.0]), rng.randrange(40)) for _ in range(500)]
    made += [(f"own{i}", float(i), i) for i in range(500)]
    df = spark.createDataFrame(made, "a string, b double, c int")
    got, want = deduplicate(df, "hashed").collect(), df.distinct().collect()
    same = lambda found: sorted(str((r.a, r.b if r.b else None if r.b is None else 0.0, r.c)) for r in found)
    assert same(got) == same(want)
    assert deduplicate(df.limit(0), "hashed").count() == 0


def test_a_row_with_a_third_of_the_table(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit("x" * 50).alias("wide"))
    assert deduplicate(df, "hashed").count() == 2001


def test_near_keys_against_all_pairs(spark):
    rng = random.Random(2)
    left = [(i, rng.uniform(0, 3), rng.uniform(-3, 0)) for i in range(300)] + [(900, None, 1.0), (901, float("nan"), 1.0), (902, 1.0, -1.0), (902, 1.0, -1.0)]
    right = [(i, rng.uniform(0, 3), rng.uniform(-3, 0)) for i in range(120)] + [(500, None, 1.0), (501, 1.0, -1.0), (501, 1.0, -1.0)]
    a = spark.createDataFrame(left, "i long, x double, y double")
    b = spark.createDataFrame(right, "j long, x double, y double")
    got = rows(join_near(a, b, ["x", "y"], 0.1), "i", "j", "x")
    near = lambda p, q: None not in (p, q) and abs(p - q) <= 0.1
    want = sorted((i, j, x) for i, x, y in left for j, u, v in right if near(x, u) and near(y, v))
    assert got == want and (902, 501, 1.0) in got and got.count((902, 501, 1.0)) == 4
    assert join_near(a, b, ["x", "y"], 0.1).columns == ["i", "x", "y", "j"]
    with pytest.raises(ValueError):
        join_near(a, b, ["x"], 0)


def test_filter_stands_below_the_aggregate(spark):
    """Q3 groups the incidents of the places in question alone."""
    import __spark_entry__ as E

    plan = executed_final_plan(E.q3_descent_extremes(spark, "/root/testdata/sf0.001"))
    below = plan[plan.index("_mask") if "_mask" in plan else plan.index("mask") :]
    assert "BroadcastHashJoin" in plan and "HashAggregate" in plan[: plan.index("mask")]
    assert below


def test_runtime_filter_changes_no_answer(spark):
    import __spark_entry__ as E
    from blotter.plans import reports as R
    from blotter.plans import standins as S

    sf = "/root/testdata/sf0.001"
    for tolerance in (None, 0.0004):
        got = []
        for on in (True, False):
            df = R.descent_in_income_extremes(
                E._base(spark, sf), S.shifted_geocode(spark, sf), S.nation_income(spark, sf), year=E.Q3_YEAR, tolerance=tolerance, runtime_filter=on
            )
            got.append(rows(df))
        assert got[0] == got[1] and (tolerance is None or got[0])


def test_catalogue_names_and_arguments(spark):
    from blotter.plans.catalog import Catalogue

    made = Catalogue(spark, "t_")
    made.crimes(spark.createDataFrame([("1", "0930", "1/2/2020 12:00:00 AM"), ("2", "x", None)], "DR_NO string, `TIME OCC` string, `Date Rptd` string"))
    made.income(spark.createDataFrame([("90001", "$1,000")], "`zip code` string, `Estimated Median Income` string"))
    got = made.sql("SELECT dr_no, time_occ, year(date_rptd) AS y FROM {crimes} WHERE dr_no < :last ORDER BY 1", last="2").collect()
    assert [tuple(r) for r in got] == [("1", 930, 2020)]
    assert made.sql("SELECT income FROM {income} WHERE zip_code = :zip", zip="90001").first().income == 1000
    # a value stays a value
    assert made.sql("SELECT count(*) AS n FROM {crimes} WHERE dr_no = :x", x="1' OR '1'='1").first().n == 0
    with pytest.raises(ValueError):
        made.table("bad", spark.sql("SELECT 1 AS `a b`, 2 AS `a_b`"))
