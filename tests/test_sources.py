"""Readers: header drift, de-duplication modes, text lines."""

from __future__ import annotations

from blotter.sources import read_crimes, read_lookup, read_text_fields
from tests.conftest import rows
from tests.fixtures import crime_csv


def test_header_drift_aligns_by_name(spark, write_csv):
    # T4: the first file spells "AREA " with a trailing space, the second "AREA".
    a = write_csv(crime_csv([{"DR_NO": "1", "AREA": "7", "AREA NAME": "Hollywood"}], area_header="AREA "))
    b = write_csv(crime_csv([{"DR_NO": "2", "AREA": "9", "AREA NAME": "Van Nuys"}], area_header="AREA"))
    df = read_crimes(spark, [a, b], dedupe=None)
    assert "AREA" in df.columns and "AREA " not in df.columns
    assert rows(df, "DR_NO", "AREA", "AREA NAME") == [("1", 7, "Hollywood"), ("2", 9, "Van Nuys")]


def test_reordered_columns_still_align(spark, write_csv):
    a = write_csv("DR_NO,LAT,LON\n1,34.0,-118.0\n")
    b = write_csv("LON,DR_NO,LAT\n-117.5,2,33.5\n")
    df = read_crimes(spark, [a, b], dedupe=None)
    assert rows(df, "DR_NO", "LAT", "LON") == [("1", 34.0, -118.0), ("2", 33.5, -117.5)]


def test_dedupe_modes(spark, write_csv):
    # T2/T3: whole-row DISTINCT removes exact copies only; two incidents in
    # the same month that differ elsewhere both stay.
    same = {"DR_NO": "1", "Date Rptd": "01/02/2020 12:00:00 AM", "Vict Age": "30"}
    other = {"DR_NO": "2", "Date Rptd": "01/02/2020 12:00:00 AM", "Vict Age": "30"}
    a = write_csv(crime_csv([same, other]))
    b = write_csv(crime_csv([same]))
    assert read_crimes(spark, [a, b], dedupe=None).count() == 3
    assert read_crimes(spark, [a, b], dedupe="rows").count() == 2
    assert read_crimes(spark, [a, b], dedupe=["Date Rptd"]).count() == 1


def test_positional_read_uses_declared_layout(spark, write_csv):
    a = write_csv(crime_csv([{"DR_NO": "5", "TIME OCC": "0930", "LON": "-118.1"}], area_header="AREA"))
    df = read_crimes(spark, [a], dedupe=None, positional=True)
    assert rows(df, "DR_NO", "TIME OCC", "LON") == [("5", 930, -118.1)]


def test_lookup_names_are_canonical(spark, write_csv):
    path = write_csv("zip code,COMMUNITY,Estimated  Median Income\n90001,A,\"$1,000\"\n")
    df = read_lookup(spark, path)
    assert df.columns == ["Zip Code", "Community", "Estimated Median Income"]
    assert rows(df) == [("90001", "A", "$1,000")]


def test_text_fields_split_naively(spark, write_csv):
    path = write_csv('a,"b,c",d\nx,y\n')
    got = sorted(r.fields for r in read_text_fields(spark, path).collect())
    assert got == [["a", '"b', 'c"', "d"], ["x", "y"]]


def test_parquet_extract_unions_with_csv(spark, write_csv, tmp_path):
    import datetime as dt

    from blotter.plans import reports as R

    typed = spark.createDataFrame(
        [(7, dt.date(2020, 3, 1), dt.datetime(2020, 2, 28, 10, 0), 35, 34.1, -118.2)],
        "DR_NO long, `Date Rptd` date, `DATE OCC` timestamp, `Vict Age` int, LAT double, LON double",
    )
    path = str(tmp_path / "extract.parquet")
    typed.write.parquet(path)
    text = write_csv(crime_csv([{"DR_NO": "8", "Date Rptd": "03/02/2020 12:00:00 AM", "Vict Age": "40"}]))
    from blotter.sources.extracts import read_csv_text, typed_crimes, union_extracts

    both = union_extracts([typed_crimes(read_csv_text(spark, path, fmt="parquet")), typed_crimes(read_csv_text(spark, text))])
    base = rows(R.base_dataset(both))
    assert base[-2:] == [
        (dt.date(2020, 3, 1), dt.date(2020, 2, 28), 35, 34.1, -118.2),
        (dt.date(2020, 3, 2), None, 40, None, None),
    ]


def test_doubled_quotes_and_quoted_commas(spark, write_csv):
    path = write_csv('DR_NO,Premis Desc,Mocodes\n1,"STREET","a, ""b"" c"\n')
    assert rows(read_crimes(spark, path, dedupe=None), "DR_NO", "Premis Desc", "Mocodes") == [("1", "STREET", 'a, "b" c')]


def test_rows_are_compared_by_value(spark, write_csv):
    a = write_csv("DR_NO,LAT,TIME OCC,Date Rptd\n1,34.10,0600,1/2/2020 12:00:00 AM\n")
    b = write_csv("DR_NO,LAT,TIME OCC,Date Rptd\n1,34.1,600,01/02/2020 12:00:00 AM\n")
    assert read_crimes(spark, [a, b]).count() == 1
    assert read_crimes(spark, [a, b], typed=False).count() == 2


def test_folder_with_two_column_orders(spark, tmp_path):
    (tmp_path / "x1.csv").write_text("DR_NO,LAT,LON\n1,34.0,-118.0\n")
    (tmp_path / "x2.csv").write_text("DR_NO,LON,LAT\n2,-117.5,33.5\n")
    (tmp_path / "x3.csv").write_text("DR_NO,LAT,LON\n3,34.5,-118.5\n")
    (tmp_path / "empty.csv").write_text("")
    want = [("1", 34.0, -118.0), ("2", 33.5, -117.5), ("3", 34.5, -118.5)]
    for path in (str(tmp_path), f"{tmp_path}/*.csv", [f"{tmp_path}/x{k}.csv" for k in (1, 2, 3)]):
        assert rows(read_crimes(spark, path, dedupe=None), "DR_NO", "LAT", "LON") == want


def test_many_files_are_one_scan_and_build_fast(spark, tmp_path):
    import time

    paths = []
    for k in range(200):
        paths.append(str(tmp_path / f"f{k}.csv"))
        (tmp_path / f"f{k}.csv").write_text(f"DR_NO,LAT,LON\n{k},34.0,-118.0\n")
    began = time.perf_counter()
    df = read_crimes(spark, paths, dedupe=None)
    took = time.perf_counter() - began
    assert df.count() == 200 and took < 10  # 3 s on an idle machine
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_compressed_files_and_quoted_headers(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write('"DR_NO","area ","Premis Desc"\n1,7,"A, ""B"""\n')
    assert rows(read_crimes(spark, str(tmp_path), dedupe=None), "DR_NO", "AREA", "Premis Desc") == [("1", 7, 'A, "B"')]


def test_key_dedupe_keeps_the_smallest_row(spark, write_csv):
    a = write_csv("DR_NO,LAT,LON\n1,35.0,-118.0\n1,34.0,-117.0\n2,33.0,-116.0\n")
    got = read_crimes(spark, a, dedupe=["DR_NO"])
    assert got.columns == ["DR_NO", "LAT", "LON"] and rows(got) == [("1", 34.0, -117.0), ("2", 33.0, -116.0)]
