"""The command line prints each report."""

from __future__ import annotations

from blotter.cli import main
from tests.fixtures import crime_csv, table_csv


def test_cli_reports(spark, write_csv, capsys):
    crimes = write_csv(crime_csv([
        {"DR_NO": "1", "Date Rptd": "01/05/2020 12:00:00 AM", "DATE OCC": "01/04/2020 12:00:00 AM", "TIME OCC": "0930",
         "Premis Desc": "STREET", "AREA": "1", "AREA NAME": "Central", "Weapon Used Cd": "120",
         "Vict Descent": "W", "LAT": "34.05", "LON": "-118.24"},
    ]))
    stations = write_csv(table_csv(["X", "Y", "FID", "DIVISION", "LOCATION", "PREC"], [[-118.25, 34.05, 1, "Central", "a", 1]]))
    geo = write_csv(table_csv(["LAT", "LON", "ZIPcode"], [[34.05, -118.24, "90001"]]))
    income = write_csv(table_csv(["Zip Code", "Community", "Estimated Median Income"], [["90001", "A", "$5"]]))
    spoilt = write_csv("DR_NO,LAT,LON\n1,34.0\n2,34.0,-118.0")
    runs = [
        (["base", "--crimes", crimes], "rows: 1"),
        (["top-months", "--crimes", crimes, "--sql"], "TotalCrimes"),
        (["street", "--crimes", crimes, "--count"], "morning"),
        (["street", "--crimes", crimes, "--text"], "morning"),
        (["descent", "--crimes", crimes, "--geocode", geo, "--income", income, "--year", "2020"], "White"),
        (["distance", "--crimes", crimes, "--stations", stations, "--by", "area"], "Central"),
        (["distance", "--crimes", crimes, "--stations", stations, "--nearest"], "2020"),
        (["descent", "--crimes", crimes, "--geocode", geo, "--income", income, "--year", "2020", "--tolerance", "0.001"], "White"),
        (["sql", "--crimes", crimes, "--text", "SELECT area_name, lat FROM {crimes} WHERE area = :a", "--set", "a=1"], "34.05"),
        (["malformed", "--crimes", crimes, spoilt], "few cells"),
        (["street", "--crimes", crimes, "--explain"], "PushedFilters"),
    ]
    for argv, expected in runs:
        assert main(argv, spark=spark) == 0
        assert expected in capsys.readouterr().out, argv
