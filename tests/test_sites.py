"""Nearest-site search: the fold and the grid search against brute force."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.operators import assigned_site, nearest_site, site_locations
from blotter.operators import sites as site_ops
from tests.fixtures import f32
from tests.planutil import executed_final_plan


def _haversine(lat1, lon1, lat2, lon2, r=6373.0):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dphi, dlam = p2 - p1, math.radians(lon2) - math.radians(lon1)
    a = math.sin(dphi / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dlam / 2) ** 2
    return r * (2 * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0.0))))


def brute(points, sites, max_km):
    out = {}
    for pid, lat, lon in points:
        best = None
        if lat is not None and lon is not None:
            for key, slat, slon in sites:
                if slat is None or slon is None:
                    continue
                d = _haversine(lat, lon, slat, slon)
                if (max_km is None or d < max_km) and (best is None or (d, key) < best):
                    best = (d, key)
        out[pid] = None if best is None else (best[1], f32(best[0]))
    return out


def run(spark, points, sites, max_km, fold=False):
    pdf = spark.createDataFrame(points, "pid long, lat double, lon double")
    sdf = spark.createDataFrame(sites, "k long, y double, x double")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(site_ops, "FOLD_BYTES", 10**12 if fold else -1)
        got = nearest_site(pdf, sdf, "lat", "lon", "k", "y", "x", max_km=max_km)
    return {r.pid: None if r.k is None else (r.k, r.distance) for r in got.collect()}


def _assert_same(got, want):
    assert set(got) == set(want)
    for pid, w in want.items():
        g = got[pid]
        if w is None:
            assert g is None, pid
        else:
            assert g is not None and g[0] == w[0], (pid, g, w)
            assert g[1] == pytest.approx(w[1], rel=1e-6)


def _cluster(rng, n, lat0, lon0, spread):
    return [(lat0 + rng.uniform(-spread, spread), lon0 + rng.uniform(-spread, spread)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1])
def test_fold_and_descent_agree_with_brute_force(spark, seed):
    rng = random.Random(seed)
    site_xy = _cluster(rng, 120, 34.0, -118.3, 0.4) + _cluster(rng, 30, 40.7, -74.0, 0.2)
    # a hot location: many sites at one point (only the smallest key can win there)
    site_xy += [(34.05, -118.25)] * 40
    sites = [(i + 1, a, b) for i, (a, b) in enumerate(site_xy)] + [(999, None, None)]
    pts = _cluster(rng, 300, 34.0, -118.3, 0.6) + _cluster(rng, 20, 51.5, 0.0, 1.0)
    points = [(i, a, b) for i, (a, b) in enumerate(pts)] + [(10_000, None, 1.0)]
    for max_km in (1000.0, 5.0, None):
        want = brute(points, sites, max_km)
        _assert_same(run(spark, points, sites, max_km, fold=True), want)
        _assert_same(run(spark, points, sites, max_km), want)


def test_descent_handles_antimeridian_and_poles(spark):
    sites = [(1, 0.0, 179.9), (2, 0.0, -170.0), (3, 89.9, 10.0), (4, -89.95, -100.0), (5, 45.0, 0.0)]
    points = [(1, 0.0, -179.95), (2, 89.99, -170.0), (3, -89.99, 80.0), (4, 44.0, 1.0), (5, 0.0, 90.0)]
    for max_km in (1000.0, None):
        want = brute(points, sites, max_km)
        _assert_same(run(spark, points, sites, max_km), want)
        _assert_same(run(spark, points, sites, max_km, fold=True), want)


@pytest.mark.parametrize("fold", [True, False])
def test_repeated_and_null_record_numbers(spark, monkeypatch, fold):
    """Points are told apart by place alone: five incidents, two sites."""
    monkeypatch.setattr(site_ops, "FOLD_BYTES", 10**12 if fold else -1)
    points = [(1, 34.0, -118.0), (1, 35.0, -118.0), (None, 34.0, -118.0), (2, 34.0, -118.0), (2, 34.0, -118.0)]
    pdf = spark.createDataFrame(points, "pid long, lat double, lon double")
    sdf = spark.createDataFrame([(1, 34.01, -118.0), (2, 35.01, -118.0)], "k long, y double, x double")
    got = nearest_site(pdf, sdf, "lat", "lon", "k", "y", "x")
    assert {r.k: r["count"] for r in got.groupBy("k").count().collect()} == {1: 4, 2: 1}


def test_six_hundred_stations_through_the_reports(spark, monkeypatch):
    from blotter.plans import reports as R

    monkeypatch.setattr(site_ops, "FOLD_BYTES", -1)
    stations = spark.createDataFrame([(k, f"S{k}", 34.0 + k * 0.001, -118.0) for k in range(600)], "PREC int, DIVISION string, Y double, X double")
    crimes = spark.createDataFrame(
        [(f"{1 + k % 12}/1/2020", "1", str(34.0 + k % 600 * 0.001), "-118.0", "101") for k in range(1200)],
        "`DATE OCC` string, AREA string, LAT string, LON string, `Weapon Used Cd` string",
    )
    rows = R.nearest_distance_by_site(crimes, stations).collect()
    assert len(rows) == 600 and all(r["count"] == 2 and r[1] == 0 for r in rows)


def test_far_point_keeps_the_rim_of_a_dense_cluster(spark):
    """A metropolis of 3,000 locations: few of them reach the last comparison."""
    sites = spark.createDataFrame(
        [(k, 34.0 + (k * 7919 % 9973) * 2e-5, -118.0 + (k * 6271 % 9941) * 2e-5) for k in range(3000)], "k long, y double, x double"
    )
    locations = site_locations(sites, "k", "y", "x")
    places = spark.createDataFrame([(36.0, -115.0), (40.0, -118.0)], "_plat double, _plon double")
    found = site_ops._nearest_by_descent(places, locations, 1000.0, 6373.0)
    assert found.count() == 2
    plan = executed_final_plan(found)
    assert "Python" not in plan


def test_no_job_runs_while_the_plan_is_built(spark, monkeypatch):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    try:
        points = spark.range(10).selectExpr("id as pid", "34.0d as lat", "-118.0d as lon")
        sites = spark.range(10).selectExpr("id as k", "34.0d + id as y", "-118.0d as x")
        for limit in (-1, 10**12):
            monkeypatch.setattr(site_ops, "FOLD_BYTES", limit)
            nearest_site(points, sites, "lat", "lon", "k", "y", "x")
            assigned_site(points, sites, "pid", "k", "lat", "lon", "y", "x")
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_site_locations_collapse_hot_location(spark):
    sdf = spark.createDataFrame([(k, 1.0, 2.0) for k in range(50, 0, -1)] + [(7, 3.0, 4.0)], "k long, y double, x double")
    locs = site_locations(sdf, "k", "y", "x").collect()
    assert sorted((r._lat, r._lon, r._site.key) for r in locs) == [(1.0, 2.0, 1), (3.0, 4.0, 7)]


def test_assigned_site_joins_on_key(spark):
    pdf = spark.createDataFrame([(1, 34.0, -118.0), (2, 34.0, -118.0), (3, 34.0, -118.0)], "a int, lat double, lon double")
    sdf = spark.createDataFrame([(1, 34.0, -118.0), (2, None, None)], "a int, y double, x double")
    got = sorted(tuple(r) for r in assigned_site(pdf, sdf, "a", "a", "lat", "lon", "y", "x").select("a", "distance").collect())
    assert got == [(1, 0.0), (2, None)]


def test_a_tiny_radius(spark):
    sites = [(k, 34.0 + k * 1e-5, -118.0) for k in range(1, 30)]
    points = [(1, 34.0001, -118.0), (2, 35.0, -118.0)]
    want = brute(points, sites, 0.05)
    _assert_same(run(spark, points, sites, 0.05), want)


@settings(max_examples=3, deadline=None)
@given(
    st.lists(st.tuples(st.floats(-60, 60), st.floats(-180, 180)), min_size=1, max_size=40),
    st.lists(st.tuples(st.floats(-60, 60), st.floats(-180, 180)), min_size=1, max_size=40),
    st.sampled_from([300.0, 3000.0, None]),
)
def test_descent_matches_brute_force_on_generated_layouts(spark, site_xy, point_xy, max_km):
    sites = [(i + 1, a, b) for i, (a, b) in enumerate(site_xy)]
    points = [(i, a, b) for i, (a, b) in enumerate(point_xy)]
    _assert_same(run(spark, points, sites, max_km), brute(points, sites, max_km))


def test_descent_has_no_search_in_a_scan_filter(spark):
    """No condition on a level's bounds is moved down to what reads the points
    or the sites: there a whole level would be computed for each row."""
    import __spark_entry__ as E

    plan = E.q4_nearest_many_sites(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("transform(" in f or "size(" in f for f in filters)
    for line in filters:
        assert line.count("pow(") <= 6, line


def test_search_parameter(spark):
    points, sites = [(1, 34.0, -118.0), (2, 10.0, 10.0), (3, None, 1.0)], [(1, 34.01, -118.0), (2, 35.01, -118.0)]
    pdf = spark.createDataFrame(points, "pid long, lat double, lon double")
    sdf = spark.createDataFrame(sites, "k long, y double, x double")
    for search in ("fold", "descent"):
        got = nearest_site(pdf, sdf, "lat", "lon", "k", "y", "x", search=search)
        assert {r.pid: r.k for r in got.collect()} == {1: 1, 2: None, 3: None}
    with pytest.raises(ValueError):
        nearest_site(pdf, sdf, "lat", "lon", "k", "y", "x", search="other")


def _most_shuffled(node):
    """Rows of the largest shuffle of an executed plan."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _most_shuffled(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _most_shuffled(node.plan())
    own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    children = node.children()
    return max(own, *(_most_shuffled(children.apply(i)) for i in range(children.size())), 0)


def test_cubes_are_cut_before_they_are_shuffled_by_place(spark):
    """A place between many far locations shuffles few of the cubes that hold them."""
    sites = spark.range(30000).selectExpr("id as k", "-69.7 + (id * 10 % 1381) * 0.1D as y", "-179.5 + (id * 70 % 3583) * 0.1D as x")
    points = spark.range(12000).selectExpr("id as pid", "-70.0 + (id * 5 % 1399) * 0.1D as lat", "-179.0 + (id * 65 % 3571) * 0.1D as lon")
    got = nearest_site(points, sites, "lat", "lon", "k", "y", "x", search="descent")
    found = {r.pid: None if r.k is None else (r.k, r.distance) for r in got.collect()}
    plan = got._jdf.queryExecution().executedPlan()
    assert _most_shuffled(plan) < 150_000
    rows = [tuple(r) for r in points.limit(10).collect()]
    _assert_same({p: found[p] for p, *_ in rows}, brute(rows, [tuple(r) for r in sites.collect()], 1000.0))
