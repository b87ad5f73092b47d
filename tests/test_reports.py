"""Reports on hand-made extracts, one case per semantic trap (T1-T20)."""

from __future__ import annotations

import datetime as dt
import math
from collections import defaultdict

import pytest

from blotter.plans import reports as R
from blotter.sources import read_crimes, read_lookup, read_text_fields
from tests.conftest import rows
from tests.fixtures import crime_csv, f32, ref_distance, table_csv

# ----------------------------------------------------------------- Q0 / Q1


@pytest.fixture
def two_extracts(write_csv):
    shared = {"DR_NO": "1", "Date Rptd": "01/05/2020 12:00:00 AM", "DATE OCC": "12/31/2019 12:00:00 AM",
              "Vict Age": "30", "LAT": "34.0", "LON": "-118.0"}
    a = [
        shared,
        {"DR_NO": "2", "Date Rptd": "01/20/2020 12:00:00 AM", "DATE OCC": "01/19/2020 12:00:00 AM", "Vict Age": "40"},
        {"DR_NO": "3", "Date Rptd": "01/21/2020 12:00:00 AM", "DATE OCC": "01/21/2020 12:00:00 AM", "Vict Age": "x", "LAT": ""},
        {"DR_NO": "4", "Date Rptd": "02/03/2020 12:00:00 AM", "DATE OCC": "02/01/2020 12:00:00 AM"},
        {"DR_NO": "5", "Date Rptd": "junk", "DATE OCC": "", "Vict Age": "22"},
    ]
    b = [
        shared,
        {"DR_NO": "6", "Date Rptd": "2/10/2020", "DATE OCC": "2/9/2020"},
        {"DR_NO": "7", "Date Rptd": "03/01/2020 12:00:00 AM", "DATE OCC": "03/01/2020 12:00:00 AM"},
        {"DR_NO": "8", "Date Rptd": "03/15/2020 01:30:00 PM", "DATE OCC": "03/15/2020 01:30:00 PM"},
        {"DR_NO": "9", "Date Rptd": "04/02/2020 12:00:00 AM", "DATE OCC": "04/02/2020 12:00:00 AM"},
        {"DR_NO": "10", "Date Rptd": "04/03/2020 12:00:00 AM", "DATE OCC": "04/03/2020 12:00:00 AM"},
        {"DR_NO": "11", "Date Rptd": "05/03/2021 12:00:00 AM", "DATE OCC": "05/03/2021 12:00:00 AM"},
    ]
    return [write_csv(crime_csv(a, "AREA ")), write_csv(crime_csv(b, "AREA"))]


def test_q0_base_dataset_types_and_dedupe(spark, two_extracts):
    base = R.base_dataset(read_crimes(spark, two_extracts, dedupe="rows"))
    assert [f.dataType.simpleString() for f in base.schema.fields] == ["date", "date", "int", "double", "double"]
    got = rows(base)
    assert len(got) == 5 + 7 - 1  # the shared row is in both files
    assert (dt.date(2020, 1, 5), dt.date(2019, 12, 31), 30, 34.0, -118.0) in got
    # T1: bad text becomes null instead of failing the job
    assert (None, None, 22, None, None) in got
    assert rows(R.row_count(base)) == [(11,)]
    rejected = read_crimes(spark, two_extracts, dedupe="rows", typed=False)
    got_rejected = R.rejected_values(rejected).first().asDict()
    assert got_rejected["Date Rptd"] == 1 and got_rejected["Vict Age"] == 1  # "junk", "x"
    assert got_rejected["DATE OCC"] == 0 and got_rejected["LAT"] == 0  # blank is absent, not rejected
    schema = [tuple(r) for r in R.schema_rows(base).collect()]
    assert schema == [("Date Rptd", "date", True), ("DATE OCC", "date", True), ("Vict Age", "int", True),
                      ("LAT", "double", True), ("LON", "double", True)]


def test_q1_top_months_ties_and_forms(spark, two_extracts):
    crimes = read_crimes(spark, two_extracts, dedupe="rows")
    df_form = rows(R.top_months(crimes, n=3))
    # 2020: Jan 3 (T2: two incidents in one month both count), Feb 2, Mar 2, Apr 2.
    # T5: the tie for third place goes to the earlier month.
    assert [r for r in df_form if r[0] == 2020] == [(2020, 1, 3, 1), (2020, 2, 2, 2), (2020, 3, 2, 3)]
    assert (2021, 5, 1, 1) in df_form
    assert (None, None, 1, 1) in df_form  # unparsable dates stay visible as a null group
    sql_form = rows(R.top_months_sql(crimes, n=3))
    # T6: the SQL form reports RANK among the picked rows: tied months share it
    assert [r for r in sql_form if r[0] == 2020] == [(2020, 1, 3, 1), (2020, 2, 2, 2), (2020, 3, 2, 2)]
    assert [r[:3] for r in df_form] == [r[:3] for r in sql_form]
    named = rows(R.top_months_sql(crimes, n=3, view="crime_data"))
    assert named == sql_form and spark.catalog.tableExists("crime_data")
    assert R.top_months(crimes).columns == ["Year", "Month", "Total Crimes", "Top Number"]
    assert R.top_months_sql(crimes).columns == ["Year", "Month", "TotalCrimes", "Rank"]


def test_q1_uses_reported_date_and_other_dates_on_request(spark, two_extracts):
    crimes = read_crimes(spark, two_extracts, dedupe="rows")
    occurred = rows(R.top_months(crimes, n=1, date_col="DATE OCC"))
    assert (2019, 12, 1, 1) in occurred  # T19: occurred in 2019, reported in 2020


# --------------------------------------------------------------------- Q2

T7_LINES = """DR_NO,Date Rptd,DATE OCC,TIME OCC,AREA NAME,Premis Desc
1,01/01/2020,01/01/2020,0930,Central,STREET
2,01/01/2020,01/01/2020,1300,STREET,PARKING LOT
3,01/01/2020,01/01/2020,1800,Central,"STREET"
4,"01/01/2020, x",01/01/2020,2200,Central,STREET
5,01/01/2020,01/01/2020,0459,Central,STREET
6,01/01/2020,01/01/2020,,Central,STREET
"""


def test_q2_column_form(spark, write_csv):
    crimes = read_crimes(spark, write_csv(T7_LINES), dedupe=None)
    out = R.street_parts_of_day(crimes)
    assert [tuple(r) for r in out.collect()] == [("night", 2), (None, 1), ("evening", 1), ("morning", 1)]


def test_q2_text_form_differs_as_documented(spark, write_csv):
    # T7: any field equal to STREET counts (line 2), a quoted "STREET" does not
    # (line 3), and a quoted comma shifts the time field (line 4 -> null).
    lines = read_text_fields(spark, write_csv(T7_LINES))
    got = {r[0]: r[1] for r in R.street_parts_of_day_text(lines).collect()}
    assert got == {"morning": 1, "afternoon": 1, "night": 1, None: 2}


def test_q2_boundaries(spark, write_csv):
    times = ["0459", "0500", "1159", "1200", "1659", "1700", "2059", "2100"]
    text = "TIME OCC,Premis Desc\n" + "".join(f"{t},STREET\n" for t in times) + "1000,SIDEWALK\n"
    got = {r[0]: r[1] for r in R.street_parts_of_day(read_crimes(spark, write_csv(text), dedupe=None)).collect()}
    assert got == {"night": 2, "morning": 2, "afternoon": 2, "evening": 2}


# --------------------------------------------------------------------- Q3


def test_q3_traps(spark, write_csv):
    income = write_csv(table_csv(
        ["Zip Code", "Community", "Estimated Median Income"],
        [["90001", "A", "$10,000"], ["90002", "B", "$50,000"], ["90003", "C", "$30,000"],
         ["90002", "B2", "$50,000"], ["90004", "D", None], ["90005", "E", "$20,000"],
         ["90006", "F", "$99,999"], ["90006", "F", "$1"]],
    ))
    geocode = write_csv(table_csv(
        ["LAT", "LON", "ZIPcode"],
        [[34.1, -118.1, "90006"], [34.1, -118.1, "90006"], [34.2, -118.2, "90002"],
         [34.3, -118.3, "90001"], [34.4, -118.4, "90001-1"], [34.5, -118.5, "90004"]],
    ))

    def crime(dr, lat, lon, code, occ="06/01/2015 12:00:00 AM", rptd="06/02/2015 12:00:00 AM"):
        return {"DR_NO": dr, "LAT": lat, "LON": lon, "Vict Descent": code, "DATE OCC": occ, "Date Rptd": rptd}

    a = [
        crime("1", "34.1", "-118.1", "W"),  # geocode row repeated x ZIP in both lists: counts 4 times
        crime("2", "34.2", "-118.2", "B"),
        crime("3", "34.3", "-118.3", "K"),  # T10: unknown codes are separate Error rows
        crime("4", "34.3", "-118.3", "Q"),
        crime("5", "34.3", "-118.3", None),  # no descent, not counted
        crime("6", "34.2", "-118.2", "B", occ="12/31/2014 12:00:00 AM", rptd="01/02/2015 12:00:00 AM"),  # T19
        crime("7", "34.9", "-118.9", "W"),  # T17: no geocode row, lost
        crime("8", "34.4", "-118.4", "H"),  # T18: text ZIP, not selected, no failure
    ]
    b = [crime("2", "34.2", "-118.2", "B")]  # exact copy of a row of the first file
    crimes = read_crimes(spark, [write_csv(crime_csv(a)), write_csv(crime_csv(b))], dedupe="rows")
    out = R.descent_in_income_extremes(crimes, read_lookup(spark, geocode), read_lookup(spark, income), year=2015)
    assert out.columns == ["Victim Descent", "#"]  # T12: no stray income column
    assert [tuple(r) for r in out.collect()] == [("White", 4), ("Black", 1), ("Error", 1), ("Error", 1)]
    # dedupe_keys: each ZIP once -> the repeated geocode row still counts twice
    once = R.descent_in_income_extremes(
        crimes, read_lookup(spark, geocode), read_lookup(spark, income), year=2015, dedupe_keys=True
    )
    assert [tuple(r) for r in once.collect()][0] == ("White", 2)


def test_q3_income_areas_with_few_zips(spark, write_csv):
    income = write_csv(table_csv(["Zip Code", "Community", "Estimated Median Income"], [["1", "a", "$5"], ["2", "b", "$7"]]))
    picked = rows(R.income_extreme_areas(read_lookup(spark, income), n=3))
    assert picked == [("1",), ("1",), ("2",), ("2",)]  # T9: fewer than 6 ZIPs repeat


# --------------------------------------------------------------------- Q4

STATIONS = [
    # X (lon), Y (lat), FID, DIVISION, LOCATION, PREC
    [-118.25, 34.05, 1, "Central", "a", 1],
    [-118.33, 34.10, 2, "Hollywood", "b", 6],
    [-118.45, 34.25, 3, "North", "c", 7],
    [-118.0, 34.5, 4, "TwinA", "d", 3],
    [-118.0, 34.5, 5, "TwinB", "e", 8],  # T15: same place as TwinA, larger number
    [None, None, 6, "Nowhere", "f", 9],  # no coordinates
]


def _q4_crime(dr, year, area, name, weapon, lat, lon):
    return {"DR_NO": dr, "DATE OCC": f"03/01/{year} 12:00:00 AM", "AREA": area, "AREA NAME": name,
            "Weapon Used Cd": weapon, "LAT": lat, "LON": lon}


Q4_CRIMES = [
    _q4_crime("1", 2019, "1", "Central", "100", "34.05", "-118.24"),
    _q4_crime("2", 2019, "6", "Hollywood", "199", "34.11", "-118.31"),
    _q4_crime("3", 2019, "1", "Central", "99", "34.05", "-118.24"),  # outside 100-199
    _q4_crime("4", 2019, "1", "Central", "200", "34.05", "-118.24"),
    _q4_crime("5", 2019, "1", "Central", "", "34.05", "-118.24"),  # null weapon
    _q4_crime("6", 2020, "6", "Hollywood", "150", "0", "-118.3"),  # T13: LAT = 0 dropped
    _q4_crime("7", 2020, "7", None, "150", "34.16", "0"),  # T13: LON = 0 kept; T11: null name
    _q4_crime("8", 2020, "6", "Hollywood", "150", "", "-118.3"),  # null LAT dropped
    _q4_crime("9", 2020, "7", "North", "120", "40.7", "-74.0"),  # T14: > 1000 km from all
    _q4_crime("10", 2021, "3", "TwinA", "110", "34.5", "-117.9"),
    _q4_crime("11", 2022, "9", "Nowhere", "130", "34.2", "-118.2"),  # station without coordinates
    _q4_crime("12", 2023, "1", "Central", "150", "40.7", "-74.0"),  # the only 2023 incident is far
    _q4_crime("13", 2019, "1", "Central", "101", "34.06", "-118.26"),
]


@pytest.fixture
def q4_inputs(spark, write_csv):
    crimes = read_crimes(spark, write_csv(crime_csv(Q4_CRIMES)), dedupe=None)
    stations = read_lookup(spark, write_csv(table_csv(["X", "Y", "FID", "DIVISION", "LOCATION", "PREC"], STATIONS)))
    return crimes, stations


def _firearm(c):
    w, lat = c["Weapon Used Cd"], c["LAT"]
    return w not in ("", None) and 100 <= int(w) <= 199 and lat not in ("", None) and f32(float(lat)) != 0


def _brute_nearest(lat, lon, max_km=1000.0):
    best = None
    for x, y, _, name, _, prec in STATIONS:
        if x is None:
            continue
        d = ref_distance(lat, lon, y, x)
        if d < max_km and (best is None or (d, prec) < (best[0], best[1])):
            best = (d, prec, name)
    return best


def _means(pairs):
    acc = defaultdict(list)
    for k, v in pairs:
        acc[k].append(v)
    return {k: (None if all(x is None for x in v) else sum(x for x in v if x is not None) / sum(x is not None for x in v), len(v))
            for k, v in acc.items()}


def test_q4_assigned(spark, q4_inputs):
    crimes, stations = q4_inputs
    by_prec = {s[5]: s for s in STATIONS}
    expected = []
    for c in Q4_CRIMES:
        if not _firearm(c):
            continue
        s = by_prec.get(int(c["AREA"]))
        if s is None:
            continue
        d = None if s[0] is None else ref_distance(float(c["LAT"]), float(c["LON"]), s[1], s[0])
        expected.append((int(c["DATE OCC"][-16:-12]), c["AREA NAME"], d))
    per_year = _means([(y, d) for y, _, d in expected])
    got = {r[0]: r[1] for r in _in_order(R.assigned_distance_by_period(crimes, stations).collect(), _smallest_first)}
    assert set(got) == set(per_year)
    for y, (m, _) in per_year.items():
        assert got[y] == (None if m is None else pytest.approx(m, rel=1e-12))
    per_area = _means([(n, d) for _, n, d in expected if n is not None])
    got_area = {r[0]: (r[1], r[2]) for r in _in_order(R.assigned_distance_by_area(crimes, stations).collect(), _most_first)}
    assert None not in got_area  # T11: the null name is no group
    assert set(got_area) == set(per_area)
    for n, (m, cnt) in per_area.items():
        assert got_area[n][1] == cnt
        assert got_area[n][0] == (None if m is None else pytest.approx(m, rel=1e-12))


def _in_order(rows, key):
    """Rows as tuples; they must come in the report's order."""
    out = [tuple(r) for r in rows]
    assert out == sorted(out, key=key)
    return out


def _smallest_first(r):  # O1: null means first
    return (r[1] is not None, r[1] or 0.0, r[0])


def _most_first(r):  # O3
    return (-r[2], r[0])


@pytest.mark.parametrize("fold_bytes", [10**12, -1])
def test_q4_nearest_matches_brute_force(spark, q4_inputs, monkeypatch, fold_bytes):
    from blotter.operators import sites as site_ops

    monkeypatch.setattr(site_ops, "FOLD_BYTES", fold_bytes)
    crimes, stations = q4_inputs
    got_rows = {}
    fired = [c for c in Q4_CRIMES if _firearm(c)]
    for c in fired:
        best = _brute_nearest(float(c["LAT"]), float(c["LON"]))
        got_rows[int(c["DR_NO"])] = best
    per_year = _means([(int(c["DATE OCC"][-16:-12]), got_rows[int(c["DR_NO"])] and got_rows[int(c["DR_NO"])][0]) for c in fired])
    got = {r[0]: r[1] for r in _in_order(R.nearest_distance_by_period(crimes, stations).collect(), _smallest_first)}
    assert set(got) == set(per_year)
    assert got[2023] is None  # T14: a year with no station in range is kept
    for y, (m, _) in per_year.items():
        assert got[y] == (None if m is None else pytest.approx(m, rel=1e-12))
    per_site = _means([(b[2], b[0]) for b in got_rows.values() if b is not None])
    got_site = {r[0]: (r[1], r[2]) for r in _in_order(R.nearest_distance_by_site(crimes, stations).collect(), _most_first)}
    assert set(got_site) == set(per_site)
    assert "TwinB" not in got_site  # T15: equal distance goes to the smaller number
    for n, (m, cnt) in per_site.items():
        assert got_site[n] == (pytest.approx(m, rel=1e-12), cnt)


def test_q4_nearest_with_no_stations(spark, write_csv, q4_inputs):
    crimes, _ = q4_inputs
    empty = read_lookup(spark, write_csv("X,Y,FID,DIVISION,LOCATION,PREC\n"))
    assert R.nearest_distance_by_site(crimes, empty).count() == 0
    per_year = R.nearest_distance_by_period(crimes, empty).collect()
    assert per_year and all(r[1] is None for r in per_year)


def test_q4_distance_is_32_bit(spark, q4_inputs):
    crimes, stations = q4_inputs
    found = R.nearest_stations(crimes, stations)
    assert dict(found.dtypes)["distance"] == "float"
    for r in found.collect():
        if r["distance"] is not None:
            assert r["distance"] == f32(r["distance"])
            assert not math.isnan(r["distance"])
