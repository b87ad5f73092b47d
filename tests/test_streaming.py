"""Reports run incrementally over a directory of arriving extracts."""

from __future__ import annotations

import os

from blotter.plans import reports as R
from blotter.sources import read_lookup
from blotter.streaming import read_crime_stream, start_report
from tests.fixtures import crime_csv, table_csv


def _incident(dr, hhmm, year, weapon="120", lat="34.05"):
    return {"DR_NO": dr, "TIME OCC": hhmm, "Premis Desc": "STREET", "DATE OCC": f"03/01/{year} 12:00:00 AM",
            "AREA": "1", "Weapon Used Cd": weapon, "LAT": lat, "LON": "-118.24"}


def test_street_report_updates_per_file(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text(crime_csv([_incident("1", "0930", 2019)]))
    stream = read_crime_stream(spark, str(inbox))
    query = start_report(R.street_parts_of_day(stream), "street_parts_stream", checkpoint_location=str(tmp_path / "ck1"))
    try:
        query.processAllAvailable()
        assert [tuple(r) for r in spark.table("street_parts_stream").collect()] == [("morning", 1)]
        (inbox / "b.csv").write_text(crime_csv([_incident("2", "2200", 2020), _incident("3", "0800", 2020)]))
        query.processAllAvailable()
        assert [tuple(r) for r in spark.table("street_parts_stream").collect()] == [("morning", 2), ("night", 1)]
    finally:
        query.stop()


def test_nearest_station_report_streams(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    stations_csv = tmp_path / "stations.csv"
    stations_csv.write_text(table_csv(["X", "Y", "FID", "DIVISION", "LOCATION", "PREC"], [[-118.25, 34.05, 1, "Central", "a", 1]]))
    stations = read_lookup(spark, str(stations_csv))
    (inbox / "a.csv").write_text(crime_csv([_incident("1", "0930", 2019), _incident("2", "0930", 2019, weapon="99")]))
    stream = read_crime_stream(spark, str(inbox))
    batch = R.nearest_distance_by_period(read_crime_stream_batch(spark, str(inbox)), stations).collect()
    query = start_report(R.nearest_distance_by_period(stream, stations), "nearest_stream", checkpoint_location=str(tmp_path / "ck2"))
    try:
        query.processAllAvailable()
        assert [tuple(r) for r in spark.table("nearest_stream").collect()] == [tuple(r) for r in batch]
    finally:
        query.stop()


def read_crime_stream_batch(spark, directory):
    from blotter.sources import read_crimes

    return read_crimes(spark, [os.path.join(directory, f) for f in sorted(os.listdir(directory))], dedupe=None)


def test_parquet_sink_holds_the_whole_report(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text(crime_csv([_incident("1", "0930", 2019), _incident("2", "1300", 2019)]))
    out = str(tmp_path / "out")
    query = start_report(
        R.street_parts_of_day(read_crime_stream(spark, str(inbox))), "street_parquet",
        sink="parquet", checkpoint_location=str(tmp_path / "ck3"), path=out,
    )
    try:
        query.processAllAvailable()
        (inbox / "b.csv").write_text(crime_csv([_incident("3", "0931", 2020)]))
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [("afternoon", 1), ("morning", 2)]


def test_default_stream_state_is_stable_across_sessions(spark):
    from blotter.session import checkpoint_root

    root = checkpoint_root(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert root == configured  # not the per-session uuid subfolder
    assert root
