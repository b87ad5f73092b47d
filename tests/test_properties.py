"""Invariants of the reports on the benchmark stand-ins, and generated inputs
for the value functions (each batch is one Spark job)."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.functions import money_to_int, part_of_day, us_date_text
from blotter.operators import assigned_site, nearest_site
from blotter.plans import reports as R
from blotter.plans import standins as S
from tests.conftest import SMOKE_DIR

SF = "/root/testdata/sf0.01"


def test_nearest_never_farther_than_assigned(spark):
    incidents = S.event_incidents(spark, SF)
    sites = R.station_sites(S.supplier_stations(spark, SF))
    fired = R.firearm_incidents(incidents, extra=("DR_NO",))
    assigned = assigned_site(fired, sites, "AREA", "AREA", "LAT", "LON", "Y", "X")
    near = nearest_site(fired, sites, "LAT", "LON", "AREA", "Y", "X", site_key_as="site")
    both = assigned.select("DR_NO", F.col("distance").alias("a")).join(
        near.select("DR_NO", F.col("distance").alias("n")), "DR_NO"
    )
    assert both.count() > 0
    assert both.filter(F.col("n") > F.col("a")).count() == 0


def test_nearest_site_counts_sum_to_incidents_in_range(spark):
    incidents = S.event_incidents(spark, SF)
    stations = S.supplier_stations(spark, SF)
    per_site = R.nearest_distance_by_site(incidents, stations)
    total = per_site.agg(F.sum("count")).first()[0]
    in_range = R.nearest_stations(incidents, stations).filter(F.col("site").isNotNull()).count()
    assert total == in_range > 0


def test_top_months_shape(spark):
    import __spark_entry__ as E

    out = E.q1_top_months(spark, SF)
    per_year = out.groupBy("Year").agg(F.count(F.lit(1)).alias("k"), F.collect_list("Top Number").alias("ranks"))
    for row in per_year.collect():
        assert row.k <= 3
        assert sorted(row.ranks) == list(range(1, row.k + 1))
    sql = E.q1_top_months_sql(spark, SF)
    assert sorted(tuple(r) for r in out.select("Year", "Month", "Total Crimes").collect()) == sorted(
        tuple(r) for r in sql.select("Year", "Month", "TotalCrimes").collect()
    )


def test_part_of_day_counts_sum_to_street_rows(spark):
    incidents = S.event_incidents(spark, SF)
    total = R.street_parts_of_day(incidents).agg(F.sum("count")).first()[0]
    assert total == incidents.filter(F.col("Premis Desc") == "STREET").count()


def test_smoke_tables_run_every_report(spark):
    import __spark_entry__ as E

    for name, fn in E.queries().items():
        if name.startswith("q"):
            assert fn(spark, SMOKE_DIR).count() >= 1, name


def _py_part(h):
    if 500 <= h < 1200:
        return "morning"
    if 1200 <= h < 1700:
        return "afternoon"
    if 1700 <= h < 2100:
        return "evening"
    return "night"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-100, max_value=2500), min_size=1, max_size=200))
def test_part_of_day_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = [r[0] for r in df.select(part_of_day(F.col("v"))).collect()]
    assert got == [_py_part(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=10**9), min_size=1, max_size=200))
def test_money_round_trip(spark, values):
    texts = [f"${v:,}" for v in values]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(money_to_int(F.col("t"))).collect()]
    assert got == [v if v <= 2**31 - 1 else None for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31)), min_size=1, max_size=200),
       st.booleans())
def test_us_date_round_trip(spark, dates, padded):
    fmt = (lambda d: d.strftime("%m/%d/%Y %I:%M:%S %p")) if padded else (lambda d: f"{d.month}/{d.day}/{d.year}")
    df = spark.createDataFrame([(fmt(d),) for d in dates], "t string")
    got = [r[0] for r in df.select(us_date_text(F.col("t"))).collect()]
    assert got == dates


@settings(max_examples=4, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["W", "B", "K", None]), st.booleans()), min_size=1, max_size=60),
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), min_size=1, max_size=20),
    st.lists(st.tuples(st.integers(0, 3), st.integers(1, 9)), min_size=1, max_size=6),
)
def test_preaggregated_descent_equals_join_then_count(spark, incidents, geocode, income):
    from blotter.plans.reports import descent_in_income_extremes, income_extreme_areas

    crimes = spark.createDataFrame(
        [(f"{p}.5", "-118.0", code, "06/01/2015" if in_year else "06/01/2014") for p, code, in_year in incidents],
        "LAT string, LON string, `Vict Descent` string, `DATE OCC` string",
    )
    geo = spark.createDataFrame([(f"{p}.5", "-118.0", str(z)) for p, z in geocode], "LAT string, LON string, ZIPcode string")
    inc = spark.createDataFrame([(str(z), f"${v}") for z, v in income], "`Zip Code` string, `Estimated Median Income` string")
    got = sorted(tuple(r) for r in descent_in_income_extremes(crimes, geo, inc, year=2015, n=2).collect())
    # the naive plan: filter, join geocode, join the ZIP list, count per code
    zips = income_extreme_areas(inc, n=2)
    naive = (
        crimes.filter(F.col("`DATE OCC`") == "06/01/2015").filter(F.col("`Vict Descent`").isNotNull())
        .join(geo, ["LAT", "LON"]).join(zips, F.col("ZIPcode") == zips["`ZIP Code`"])
        .groupBy("`Vict Descent`").count().collect()
    )
    labels = {"W": "White", "B": "Black"}
    want = sorted((labels.get(r[0], "Error"), r[1]) for r in naive)
    assert got == want


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.integers(1, 3), st.integers(90, 210)), min_size=1, max_size=50))
def test_single_aggregate_equals_mean_join_count(spark, incidents):
    crimes = spark.createDataFrame(
        [("06/01/2015", str(a), name, str(w), f"34.{a}", "-118.1") for name, a, w in incidents],
        "`DATE OCC` string, AREA string, `AREA NAME` string, `Weapon Used Cd` string, LAT string, LON string",
    )
    stations = spark.createDataFrame([(str(a), f"S{a}", "34.05", "-118.25") for a in (1, 2, 3)], "PREC string, DIVISION string, Y string, X string")
    got = sorted(tuple(r) for r in R.assigned_distance_by_area(crimes, stations).collect())
    # the reference's form: mean per name JOIN count per name (inner, so the null name vanishes)
    fired = R.firearm_incidents(crimes, extra=("AREA NAME",))
    joined = assigned_site(fired, R.station_sites(stations), "AREA", "AREA", "LAT", "LON", "Y", "X")
    mean = joined.groupBy("`AREA NAME`").agg(F.avg("distance").alias("avg(distance)"))
    count = joined.groupBy("`AREA NAME`").count()
    want = sorted(tuple(r) for r in mean.join(count, "AREA NAME").select("`AREA NAME`", "`avg(distance)`", "count").collect())
    assert [(a, c) for a, _, c in got] == [(a, c) for a, _, c in want]
    for (_, g, _), (_, w, _) in zip(got, want):
        assert g == pytest.approx(w, rel=1e-12)
