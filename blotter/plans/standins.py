"""Incident-shaped inputs derived from the benchmark tables.

The benchmark tables (orders, customer, nation, supplier, events) carry no
incidents, so each report runs on a derivation with the same column contract.
Every derivation reads its whole table; the derived attributes are plain
arithmetic on existing columns, repeated in the DuckDB oracle SQL of
``__spark_entry__``. Numeric literals are Python floats, i.e. doubles (the
SQL side casts them to DOUBLE as well).

- extracts: ``orders`` as two overlapping yearly extracts in raw text form,
  which write equal values differently (padded and unpadded dates and numbers),
  so Q0, Q1 and Q3 go through union, typing and whole-row de-duplication;
- geocode: one point per customer, ZIP code = the customer's nation;
- income: per nation, the floor of the customers' mean balance, as money text;
- incidents: ``events`` typed as an extract (Q2, Q4); placeholder (0, 0)
  coordinates on error events, firearm codes from the event value;
- stations: ``supplier``, located on a 21-point lattice (so several suppliers
  share one location and ties between them are real), named by ``s_name``;
- many stations: ``orders``, nine of ten in a dense cluster, the rest all over
  the globe, for ``events`` of which one in five is anywhere, and whose record
  numbers repeat or are null;
- CSV files: those lines under two headers, in files that Spark writes to the
  checkpoint folder, some of them with missing or further cells or an open quote;
- CSV lines: ``events`` as quoted lines with unpadded dates, decimal whole
  numbers and values that do not parse, under a header in another spelling.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.values import hhmm_of
from blotter.session import checkpoint_dir
from blotter.sources.extracts import read_table

# Extract split: the first "file" holds orders before 1999, the second those
# from 1998 on, so 1998 is in both and whole-row DISTINCT must remove it.
FIRST_UNTIL = "1999-01-01"
SECOND_FROM = "1998-01-01"
DATE_TEXT = "MM/dd/yyyy hh:mm:ss a"
SHORT_DATE_TEXT = "M/d/yyyy h:mm:ss a"
# Header cells of the CSV lines, spelled as some yearly files do.
LINE_HEADER = ("dr_no", "DATE RPTD", "Date  Occ", "TIME OCC ", "area ", "PREMIS DESC", "Vict age", "lat", "LON")


def customer_lat(custkey: Column) -> Column:
    return F.lit(33.0) + F.floor(custkey / 1000) * F.lit(0.001)


def customer_lon(custkey: Column) -> Column:
    return F.lit(-118.0) - (custkey % 1000) * F.lit(0.001)


def _descent_code(priority: Column, status: Column) -> Column:
    """W, B, H for priorities 1-3; K, Z (no label) for 4-5; null for status P."""
    digit = F.substring(priority, 1, 1)
    code = (
        F.when(digit == "1", "W").when(digit == "2", "B").when(digit == "3", "H").when(digit == "4", "K").otherwise("Z")
    )
    return F.when(status == "P", F.lit(None).cast("string")).otherwise(code)


def order_extracts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two raw-text incident extracts built from ``orders``."""
    orders = read_table(spark, sf_dir, "orders")
    occurred = F.date_sub(F.to_date("o_orderdate"), F.dayofmonth("o_orderdate"))
    lat, lon = customer_lat(F.col("o_custkey")).cast("string"), customer_lon(F.col("o_custkey")).cast("string")
    age = F.floor(F.col("o_totalprice") / 5000).cast("string")

    def text(dates: str, numbers) -> DataFrame:
        return orders.select(
            F.col("o_orderkey").cast("string").alias("DR_NO"),
            F.date_format("o_orderdate", dates).alias("Date Rptd"),
            F.date_format(occurred, dates).alias("DATE OCC"),
            numbers(age).alias("Vict Age"),
            _descent_code(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("Vict Descent"),
            numbers(lat).alias("LAT"),
            numbers(lon).alias("LON"),
            F.col("o_orderdate").alias("_when"),
        )

    # An order without a date is in the first extract.
    until = F.coalesce(F.col("_when") < F.lit(FIRST_UNTIL).cast("timestamp_ntz"), F.lit(True))
    first = text(DATE_TEXT, lambda c: c).filter(until).drop("_when")
    with_zeros = lambda c: F.concat(c, F.when(c.contains("."), "00").otherwise(".0"))
    since = F.col("_when") >= F.lit(SECOND_FROM).cast("timestamp_ntz")
    second = text(SHORT_DATE_TEXT, with_zeros).filter(since).drop("_when")
    return [first, second]


def customer_geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer")
    return customers.select(
        customer_lat(F.col("c_custkey")).alias("LAT"),
        customer_lon(F.col("c_custkey")).alias("LON"),
        F.col("c_nationkey").cast("string").alias("ZIPcode"),
    )


def nation_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer")
    nations = read_table(spark, sf_dir, "nation")
    mean = customers.groupBy("c_nationkey").agg(F.floor(F.avg("c_acctbal")).alias("m"))
    joined = mean.join(nations, mean["c_nationkey"] == nations["n_nationkey"], "inner")
    return joined.select(
        F.col("n_nationkey").cast("string").alias("Zip Code"),
        F.col("n_name").alias("Community"),
        F.concat(F.lit("$"), F.format_number(F.col("m"), 0)).alias("Estimated Median Income"),
    )


def event_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a typed incident extract."""
    events = read_table(spark, sf_dir, "events")
    ts = F.col("ts")
    lat = F.lit(33.7) + ((F.minute(ts) * 60 + F.second(ts)) / F.lit(3600.0)) * F.lit(0.6)
    lon = F.lit(-118.7) + (((F.dayofmonth(ts) - 1) * 24 + F.hour(ts)) / F.lit(744.0)) * F.lit(0.6)
    is_error = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").alias("DR_NO"),
        ts.alias("DATE OCC"),
        hhmm_of(ts).alias("TIME OCC"),
        F.col("user_id").alias("AREA"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("string"))
        .otherwise(F.format_string("Supplier#%09d", F.col("user_id")))
        .alias("AREA NAME"),
        F.when(F.col("event_type") == "click", F.lit("STREET")).otherwise(F.upper("event_type")).alias("Premis Desc"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("int"))
        .otherwise(F.floor(F.col("value") * 4).cast("int"))
        .alias("Weapon Used Cd"),
        F.when(is_error, F.lit(0.0)).otherwise(lat).alias("LAT"),
        F.when(is_error, F.lit(0.0)).otherwise(lon).alias("LON"),
    )


def dated_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_incidents`` with occurrence dates over several years, as text."""
    when = F.make_date(2010 + F.col("DR_NO").cast("int") % 7, F.month("DATE OCC"), F.lit(1))
    return event_incidents(spark, sf_dir).withColumn("DATE OCC", F.date_format(when, "M/d/yyyy"))


def scattered_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_incidents`` with one in five anywhere on the globe; record
    numbers repeat or are null."""
    key = F.col("DR_NO")
    far = key % 5 == 0
    return event_incidents(spark, sf_dir).select(
        F.when(key % 7 != 0, F.floor(key / 3)).alias("DR_NO"), "DATE OCC", "AREA", "Weapon Used Cd",
        F.when(far, F.lit(-70.0) + (key % 1399) * F.lit(0.1)).otherwise(F.col("LAT")).alias("LAT"),
        F.when(far, F.lit(-179.0) + ((key * 13) % 3571) * F.lit(0.1)).otherwise(F.col("LON")).alias("LON"),
    )


def order_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station for each order: nine of ten in a dense cluster, the rest far apart."""
    key = F.col("o_orderkey")
    far = key % 10 == 0
    return read_table(spark, sf_dir, "orders").select(
        F.when(far, F.lit(-179.5) + ((key * 7) % 3583) * F.lit(0.1))
        .otherwise(F.lit(-118.4) + ((key * 6271) % 9941) * F.lit(0.00002)).cast("float").alias("X"),
        F.when(far, F.lit(-69.7) + (key % 1381) * F.lit(0.1))
        .otherwise(F.lit(33.9) + ((key * 7919) % 9973) * F.lit(0.00002)).cast("float").alias("Y"),
        key.cast("int").alias("PREC"),
        F.format_string("Order#%09d", key).alias("DIVISION"),
    )


def _line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key and the written cells of ``csv_lines``, one column each."""
    inc = event_incidents(spark, sf_dir)
    key = F.col("DR_NO")
    when = F.make_date(2015 + key.cast("int") % 3, F.month("DATE OCC"), F.dayofmonth("DATE OCC") % 28 + 1)
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    cells = (
        key.cast("string"),
        F.when(key % 11 == 0, F.lit("no date")).otherwise(F.date_format(when, "M/d/yyyy h:mm:ss a")),
        F.date_format(when, "MM/dd/yyyy"),
        F.lpad(F.col("TIME OCC").cast("string"), 4, "0"),
        F.concat(F.col("AREA").cast("string"), F.lit(".0")),
        quoted(F.concat(F.col("Premis Desc"), F.lit(', ""'), F.col("AREA").cast("string"), F.lit('""'))),
        F.when(key % 13 == 0, F.lit("n/a")).when(key % 17 == 0, F.lit("")).otherwise((key % 90).cast("string")),
        F.col("LAT").cast("string"),
        F.col("LON").cast("string"),
    )
    return inc.select(key.alias("key"), *[c.alias(f"c{i}") for i, c in enumerate(cells)])


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as CSV lines (``value``) in the order of ``LINE_HEADER``."""
    return _line_cells(spark, sf_dir).select(F.concat_ws(",", *[f"c{i}" for i in range(len(LINE_HEADER))]).alias("value"))


def _written_lines(spark: SparkSession, lines: DataFrame, header: str) -> str:
    """A new folder of files with ``lines`` (one column) below ``header``, in
    the shared checkpoint folder. The writer quotes nothing: the lines are CSV."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/standin-{uuid.uuid4().hex}"
    options = {"header": True, "sep": "\x01", "quote": "\x00", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.select(F.col(lines.columns[0]).alias(header)).write.options(**options).csv(folder)
    return folder


def csv_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """``csv_lines`` as two folders of files: odd records under ``LINE_HEADER``,
    even ones with the columns the other way round under other spellings."""
    cells = _line_cells(spark, sf_dir)
    columns = [f"c{i}" for i in range(len(LINE_HEADER))]
    odd = cells.filter("key % 2 = 1").select(F.concat_ws(",", *columns).alias("value"))
    even = cells.filter("key % 2 = 0").select(F.concat_ws(",", *columns[::-1]).alias("value"))
    turned = [f" {c.upper()} " if i % 2 else c.lower() for i, c in enumerate(LINE_HEADER[::-1])]
    return [_written_lines(spark, odd, ",".join(LINE_HEADER)), _written_lines(spark, even, ",".join(turned))]


def spoilt_csv_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """``csv_lines`` as files in which some lines miss their last cells, have
    one more, or an open quote."""
    cells = _line_cells(spark, sf_dir)
    columns = [f"c{i}" for i in range(len(LINE_HEADER))]
    key, whole = F.col("key"), F.concat_ws(",", *columns)
    opened = F.concat_ws(",", *columns[:5], F.expr("substring(c5, 1, length(c5) - 1)"), *columns[6:])
    line = (
        F.when(key % 19 == 0, F.concat_ws(",", *columns[:7])).when(key % 23 == 0, F.concat_ws(",", whole, F.lit("x")))
        .when(key % 29 == 0, opened).otherwise(whole)
    )
    return [_written_lines(spark, cells.select(line.alias("value")), ",".join(LINE_HEADER))]


def text_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """``event_lines`` as two folders of text files: odd and even records."""
    lines = event_lines(spark, sf_dir).select("value")
    odd = F.substring_index("value", ",", 1).cast("long") % 2 == 1
    folders = []
    for part in (lines.filter(odd), lines.filter(~odd)):
        folders.append(f"{checkpoint_dir(spark).rstrip('/')}/standin-{uuid.uuid4().hex}")
        part.write.text(folders[-1])
    return folders


def shifted_geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_geocode`` with latitudes that are up to 0.0003 degrees off."""
    key = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        (customer_lat(key) + (key % 3 - 1) * F.lit(0.0003)).alias("LAT"),
        customer_lon(key).alias("LON"),
        F.col("c_nationkey").cast("string").alias("ZIPcode"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_incidents`` as comma-joined text lines split back into ``fields``
    (time of day at field 3), for the text form of Q2."""
    inc = event_incidents(spark, sf_dir)
    line = F.concat_ws(
        ",",
        F.col("DR_NO").cast("string"),
        F.date_format("DATE OCC", DATE_TEXT),
        F.date_format("DATE OCC", DATE_TEXT),
        F.lpad(F.col("TIME OCC").cast("string"), 4, "0"),
        F.col("AREA").cast("string"),
        F.col("Premis Desc"),
    )
    return inc.select(line.alias("value")).select("value", F.split(F.col("value"), ",", -1).alias("fields"))


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = read_table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    return suppliers.select(
        (F.lit(-118.6) + ((key * 7) % 21) * F.lit(0.02)).cast("float").alias("X"),
        (F.lit(33.7) + (key % 21) * F.lit(0.03)).cast("float").alias("Y"),
        key.cast("int").alias("PREC"),
        F.col("s_name").alias("DIVISION"),
    )
