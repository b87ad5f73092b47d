"""Physical-plan checks: native expressions only, pushdown, pre-aggregation."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from blotter.plans import reports as R
from blotter.sources import read_crimes
from tests.planutil import executed_final_plan
from tests.conftest import SMOKE_DIR
from tests.fixtures import crime_csv

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def executed_plan(df) -> str:
    return executed_final_plan(df)


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n.startswith("q")))
def test_no_python_in_any_registered_query(spark, name):
    df = E.queries()[name](spark, SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()
    for node in PYTHON_NODES:
        assert node not in plan, f"{name} runs Python: {node}"


def test_top_months_uses_group_limit(spark):
    plan = executed_plan(E.q1_top_months(spark, SMOKE_DIR))
    assert "WindowGroupLimit" in plan


def test_street_filter_reaches_the_csv_scan(spark, write_csv):
    path = write_csv(crime_csv([{"DR_NO": "1", "TIME OCC": "0930", "Premis Desc": "STREET"}]))
    df = R.street_parts_of_day(read_crimes(spark, path, dedupe=None))
    plan = executed_plan(df)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(Premis Desc,STREET\)", plan), plan
    # column pruning: only the two used columns are read
    assert re.search(r"ReadSchema: struct<TIME OCC:string,Premis Desc:string>", plan), plan


def test_descent_report_aggregates_before_the_geocode_join(spark):
    plan = E.q3_descent_extremes(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "Join" in line)
    below = "\n".join(lines[join_at:])
    assert "partial_count" in below  # incidents are counted per place below the join


def test_nearest_fold_runs_once_per_point(spark):
    plan = E.q4_nearest_by_site(spark, SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_min(transform(") == 1, plan


def test_text_form_splits_a_kept_line_once(spark, tmp_path):
    from blotter.sources import read_text_fields

    path = tmp_path / "lines.txt"
    path.write_text("1,a,b,0930,7,STREET\n2,a,b,1830,7,STREET\n3,a,b,x,STREET\n4,a,b,0930,STREETS\n")
    df = R.street_parts_of_day_text(read_text_fields(spark, str(path)))
    assert sorted((r[0] or "", r[1]) for r in df.collect()) == [("", 1), ("evening", 1), ("morning", 1)]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_filters_reach_the_parquet_scan_of_the_reader(spark, tmp_path):
    path = str(tmp_path / "crimes.parquet")
    spark.sql(
        "select 1L as DR_NO, timestamp'2015-03-01 00:00:00' as `DATE OCC`, date'2015-03-02' as `Date Rptd`, 3 as AREA, "
        "101 as `Weapon Used Cd`, 34.0d as LAT, -118.0d as LON, 'W' as `Vict Descent`, 'x' as Extra"
    ).write.parquet(path)
    plan = executed_plan(R.firearm_incidents(read_crimes(spark, path, dedupe=None, fmt="parquet")))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)
    assert "Weapon Used Cd" in pushed and "LAT" in pushed and "Extra" not in plan
    from blotter.functions.typed import in_date_range

    crimes = read_crimes(spark, path, dedupe=None, fmt="parquet")
    year = executed_plan(crimes.filter(in_date_range(crimes, "DATE OCC", "2015-01-01", "2016-01-01")).select("AREA"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(`?DATE OCC`?,2015-01-01", year), year


def test_base_dataset_reads_only_needed_columns_of_orders(spark):
    plan = executed_plan(E.q2_street_parts(spark, SMOKE_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


@pytest.mark.parametrize("name", ["q4_assigned_by_day", "q4_assigned_by_area", "q4_nearest_by_day", "q4_nearest_by_site"])
def test_q4_scans_the_incident_table_once(spark, name):
    plan = executed_plan(E.queries()[name](spark, SMOKE_DIR))
    assert len(re.findall(r"events\.parquet", plan)) == 1, plan


def test_year_filter_reaches_a_typed_parquet_scan(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "typed.parquet")
    spark.createDataFrame(
        [(dt.datetime(2015, 6, 1, 10, 0), "W", 34.1, -118.2), (dt.datetime(2016, 6, 1, 10, 0), "B", 34.1, -118.2)],
        "`DATE OCC` timestamp_ntz, `Vict Descent` string, LAT double, LON double",
    ).write.parquet(path)
    geo = spark.createDataFrame([(34.1, -118.2, "1")], "LAT double, LON double, ZIPcode string")
    income = spark.createDataFrame([("1", "$5")], "`Zip Code` string, `Estimated Median Income` string")
    out = R.descent_in_income_extremes(spark.read.parquet(path), geo, income, year=2015, n=1)
    assert [tuple(r) for r in out.collect()] == [("White", 2)]  # the ZIP is both richest and poorest
    plan = executed_plan(out)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(`?DATE OCC`?,2015-01-01", plan), plan


def test_firearm_filter_reaches_a_typed_parquet_scan(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "typed_q4.parquet")
    spark.createDataFrame(
        [(dt.date(2015, 6, 1), 1, "C", 150, 34.1, -118.2), (dt.date(2015, 6, 2), 1, "C", 99, 34.1, -118.2)],
        "`DATE OCC` date, AREA int, `AREA NAME` string, `Weapon Used Cd` int, LAT float, LON float",
    ).write.parquet(path)
    stations = spark.createDataFrame([(1, "C", 34.0, -118.0)], "PREC int, DIVISION string, Y float, X float")
    out = R.assigned_distance_by_period(spark.read.parquet(path), stations)
    assert out.count() == 1
    plan = executed_plan(out)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(`?Weapon Used Cd`?,100\)", plan), plan
    assert "AREA NAME" not in re.search(r"ReadSchema: (struct<[^\n]*)", plan).group(1)  # pruned
