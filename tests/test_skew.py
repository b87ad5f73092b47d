"""A third of all rows on one key: results stay whole and the plans collapse
the hot key before it is shuffled (or never shuffle it at all)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from blotter.operators import site_locations
from blotter.plans import reports as R
from blotter.sources import deduplicate
from tests.planutil import executed_final_plan


def _executed(df) -> str:
    return executed_final_plan(df)


def _crimes(spark, n=3000):
    # rows i % 3 == 0 share one place, one area and one month
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        lat, lon = (34.0, -118.0) if hot else (34.0 + (i % 50) * 0.001, -118.1)
        rows.append((str(i), "06/01/2015" if hot else f"{1 + i % 12}/02/2015", str(lat), str(lon),
                     "W" if i % 2 else "B", "1" if hot else str(1 + i % 20), "150"))
    return spark.createDataFrame(rows, "DR_NO string, `DATE OCC` string, LAT string, LON string, "
                                       "`Vict Descent` string, AREA string, `Weapon Used Cd` string")


def test_hot_place_is_one_row_at_the_join(spark):
    crimes = _crimes(spark)
    geo = spark.createDataFrame(
        [("34.0", "-118.0", "1")] + [(str(34.0 + k * 0.001), "-118.1", "2") for k in range(50)],
        "LAT string, LON string, ZIPcode string",
    )
    income = spark.createDataFrame([("1", "$10"), ("2", "$20")], "`Zip Code` string, `Estimated Median Income` string")
    out = R.descent_in_income_extremes(crimes, geo, income, year=2015, n=1)
    got = {r[0]: r[1] for r in out.collect()}
    # every incident is located and both ZIPs are selected once each
    assert got == {"White": 1500, "Black": 1500}
    plan = _executed(out)
    # incidents are counted per (place, code) map-side before any exchange
    assert re.search(r"HashAggregate\(keys=\[[^\]]*LAT[^\]]*\], functions=\[partial_count", plan), plan


def test_hot_area_join_does_not_shuffle_incidents(spark):
    crimes = _crimes(spark)
    stations = spark.createDataFrame(
        [(str(k), f"S{k}", "34.05", "-118.25") for k in range(1, 21)], "PREC string, DIVISION string, Y string, X string"
    )
    out = R.assigned_distance_by_period(crimes, stations, period="month")
    plan = _executed(out)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    total = R.firearm_incidents(crimes).count()
    assert total == 3000
    months = {6} | {1 + i % 12 for i in range(3000) if i % 3}
    assert sorted(r[0] for r in out.collect()) == sorted(months)


def test_hot_duplicate_rows_collapse_before_the_shuffle(spark):
    rows = [("same", "row")] * 1000 + [(f"k{i}", "x") for i in range(500)]
    df = spark.createDataFrame(rows, "a string, b string")
    out = deduplicate(df, "rows")
    assert out.count() == 501
    plan = _executed(out)
    partial_then_exchange = re.search(r"HashAggregate\(keys=\[a[^\n]*\n[^\n]*Exchange hashpartitioning", plan) or re.search(
        r"Exchange hashpartitioning\(a[^\n]*\n[^\n]*HashAggregate\(keys=\[a", plan
    )
    assert partial_then_exchange, plan


def test_hot_site_location_is_one_candidate(spark):
    sites = spark.createDataFrame(
        [(k, 34.0, -118.0) for k in range(1, 3001)] + [(5000 + k, 34.1 + k * 0.01, -118.2) for k in range(10)],
        "k long, y double, x double",
    )
    locs = site_locations(sites, "k", "y", "x")
    assert locs.count() == 11
    assert locs.filter(F.col("_lat") == 34.0).first()._site.key == 1
