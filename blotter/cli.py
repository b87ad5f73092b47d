"""Command line: run one report over extract files and print it.

    python -m blotter base       --crimes a.csv b.csv
    python -m blotter top-months --crimes a.csv b.csv [--sql] [--n 3]
    python -m blotter street     --crimes a.csv b.csv [--text]
    python -m blotter descent    --crimes a.csv b.csv --geocode g.csv --income i.csv [--year 2015]
    python -m blotter distance   --crimes a.csv b.csv --stations s.csv [--nearest] [--by year|area]
    python -m blotter malformed  --crimes a.csv b.csv
    python -m blotter sql        --crimes a.csv b.csv --text "SELECT count(*) FROM {crimes} WHERE area = :area" --set area=7

On a cluster: ``spark-submit bin/blotter-report.py <same arguments>``; the
session comes from spark-submit's configuration. Only the printed rows
(``--show``, default 20) reach the driver; counts are computed by Spark.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from blotter.plans import reports as R
from blotter.plans.catalog import Catalogue
from blotter.sources import malformed_lines, read_crimes, read_lookup, read_text_fields


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="blotter", description="Incident reports on Spark")
    sub = p.add_subparsers(dest="report", required=True)

    def common(name: str, help_text: str) -> argparse.ArgumentParser:
        s = sub.add_parser(name, help=help_text)
        s.add_argument("--crimes", nargs="+", required=True, help="crime extract files (CSV unless --format)")
        s.add_argument("--format", default="csv", help="format of the extract and lookup files (csv, parquet, ...)")
        s.add_argument("--show", type=int, default=20, help="rows to print")
        s.add_argument("--count", action="store_true", help="also print the number of result rows")
        s.add_argument("--explain", action="store_true", help="print the physical plan instead of running it")
        return s

    common("base", "Q0: typed base dataset, its row count and schema")
    s = common("top-months", "Q1: top months per year")
    s.add_argument("--n", type=int, default=3)
    s.add_argument("--sql", action="store_true", help="the SQL form (RANK among the picked months)")
    s.add_argument("--date", default="Date Rptd", help="date column to rank by")
    s = common("street", "Q2: street incidents by part of day")
    s.add_argument("--text", action="store_true", help="naive text-line form")
    s = common("descent", "Q3: victims by descent in the richest and poorest ZIP codes")
    s.add_argument("--geocode", required=True, help="LAT, LON, ZIPcode extract")
    s.add_argument("--income", required=True, help="Zip Code, Estimated Median Income extract")
    s.add_argument("--year", type=int, default=2015)
    s.add_argument("--n", type=int, default=3)
    s.add_argument("--distinct-zips", action="store_true", help="count a ZIP in both lists once")
    s.add_argument("--tolerance", type=float, help="degrees by which an incident may be off a geocoded place")
    common("malformed", "lines whose cells don't fit their file's header (CSV)")
    s = common("sql", "a statement over the extracts: {crimes} is a view with lower-case column names")
    s.add_argument("--text", required=True, help="the statement; :name is an argument")
    s.add_argument("--set", nargs="*", default=[], metavar="NAME=VALUE", help="arguments; whole numbers are numbers, the rest is text")
    s.add_argument("--distinct", action="store_true", help="repeated rows count once")
    s = common("distance", "Q4: firearm incidents, distance to the assigned or nearest station")
    s.add_argument("--stations", required=True, help="X (lon), Y (lat), DIVISION, PREC extract")
    s.add_argument("--nearest", action="store_true", help="nearest station instead of the assigned one")
    s.add_argument("--by", choices=["year", "month", "day", "area"], default="year")
    s.add_argument("--max-km", type=float, default=1000.0, help="nearest search radius; beyond it, no station")
    return p


def build(spark: SparkSession, args: argparse.Namespace):
    """The report DataFrame for parsed ``args`` (nothing runs yet)."""
    fmt = args.format
    if args.report == "base":
        return R.base_dataset(read_crimes(spark, args.crimes, dedupe="rows", fmt=fmt))
    if args.report == "top-months":
        crimes = read_crimes(spark, args.crimes, dedupe="rows", fmt=fmt)
        form = R.top_months_sql if args.sql else R.top_months
        return form(crimes, n=args.n, date_col=args.date)
    if args.report == "street":
        if args.text:
            return R.street_parts_of_day_text(read_text_fields(spark, args.crimes))
        return R.street_parts_of_day(read_crimes(spark, args.crimes, dedupe=None, fmt=fmt))
    if args.report == "descent":
        crimes = read_crimes(spark, args.crimes, dedupe="rows", fmt=fmt)
        return R.descent_in_income_extremes(
            crimes, read_lookup(spark, args.geocode, fmt), read_lookup(spark, args.income, fmt),
            year=args.year, n=args.n, dedupe_keys=args.distinct_zips, tolerance=args.tolerance,
        )
    if args.report == "malformed":
        return malformed_lines(spark, args.crimes)
    if args.report == "sql":
        made = Catalogue(spark)
        made.crimes(read_crimes(spark, args.crimes, dedupe="rows" if args.distinct else None, fmt=fmt))
        given = (pair.partition("=") for pair in args.set)
        return made.sql(args.text, **{name: int(v) if v.lstrip("-").isdigit() else v for name, _, v in given})
    crimes = read_crimes(spark, args.crimes, dedupe=None, fmt=fmt)
    stations = read_lookup(spark, args.stations, fmt)
    if args.nearest:
        if args.by == "area":
            return R.nearest_distance_by_site(crimes, stations, max_km=args.max_km)
        return R.nearest_distance_by_period(crimes, stations, period=args.by, max_km=args.max_km)
    if args.by == "area":
        return R.assigned_distance_by_area(crimes, stations)
    return R.assigned_distance_by_period(crimes, stations, period=args.by)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"blotter-{args.report}").getOrCreate()
    result = build(spark, args)
    if args.explain:
        result.explain("formatted")
        return 0
    result.show(args.show, truncate=False)
    if args.count or args.report == "base":
        print(f"rows: {R.row_count(result).first()[0]}")
    if args.report == "base":
        R.schema_rows(result).show(truncate=False)
        # values present in the files that failed typing (they became null)
        R.rejected_values(read_crimes(spark, args.crimes, dedupe="rows", fmt=args.format, typed=False)).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
