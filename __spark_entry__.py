"""

Each registered query runs a report of ``blotter.plans.reports`` on inputs
derived from the benchmark tables by ``blotter.plans.standins`` (whole
tables). The oracle SQL recomputes the same answer independently in DuckDB,
straight from the tables, with the same derivation arithmetic. Means are
rounded to 6 decimals on both sides, as summation order is not fixed.
"""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

# Importable however this file is loaded (by path, from another folder). The
# reports run no Python on executors but to find the headers of files; most of
# the corpus queries do, and executors need the package for them.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from blotter.operators.partials import Partials  # noqa: E402
from blotter.operators.sites import assigned_site  # noqa: E402
from blotter.plans import catalog as C  # noqa: E402
from blotter.plans import reports as R  # noqa: E402
from blotter.plans import standins as S  # noqa: E402
from blotter.session import checkpoint_dir  # noqa: E402
from blotter.sources.extracts import (  # noqa: E402
    deduplicate, malformed_lines, parse_lines, read_crimes, read_text_fields, typed_crimes, union_extracts,
)

SMOKE_DIR = "/root/testdata/sf0.001"
DIGITS = 6
Q3_YEAR = 1997


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q0 loader: both extracts, typed, UNION ALL, whole-row DISTINCT."""
    return deduplicate(typed_crimes(union_extracts(S.order_extracts(spark, sf_dir))), "rows")


def q0_base(spark, sf_dir):
    return R.base_dataset(_base(spark, sf_dir))


def q0_rows(spark, sf_dir):
    return R.row_count(R.base_dataset(_base(spark, sf_dir)))


def q1_top_months(spark, sf_dir):
    return R.top_months(_base(spark, sf_dir), n=3)


def q1_top_months_sql(spark, sf_dir):
    return R.top_months_sql(_base(spark, sf_dir), n=3)


def q0_csv_lines(spark, sf_dir):
    """Quoted CSV lines under a header in another spelling, parsed and typed."""
    return R.base_dataset(typed_crimes(parse_lines(S.csv_lines(spark, sf_dir), S.LINE_HEADER)))


def q0_rejected_values(spark, sf_dir):
    return R.rejected_values(parse_lines(S.csv_lines(spark, sf_dir), S.LINE_HEADER))


def q1_top_months_view(spark, sf_dir):
    return R.top_months_sql(_base(spark, sf_dir), n=3, view="crime_dates")


def q2_street_parts_csv(spark, sf_dir):
    """Hours of the street lines, whose premise holds commas and quotes."""
    crimes = parse_lines(S.csv_lines(spark, sf_dir), S.LINE_HEADER)
    premise = F.substring_index("Premis Desc", ", ", 1)
    return R.street_parts_of_day(crimes.withColumn("Premis Desc", premise))


def q2_street_parts_text_sets(spark, sf_dir):
    """Text form over two sets of lines (UNION ALL): odd and even records."""
    lines = S.event_lines(spark, sf_dir)
    odd = F.substring_index("value", ",", 1).cast("long") % 2 == 1
    return R.street_parts_of_day_text(lines.filter(odd).unionByName(lines.filter(~odd)))


def q2_street_parts(spark, sf_dir):
    return R.street_parts_of_day(S.event_incidents(spark, sf_dir))


def q2_street_parts_text(spark, sf_dir):
    return R.street_parts_of_day_text(S.event_lines(spark, sf_dir))


def q3_descent_extremes(spark, sf_dir):
    return R.descent_in_income_extremes(
        _base(spark, sf_dir), S.customer_geocode(spark, sf_dir), S.nation_income(spark, sf_dir), year=Q3_YEAR, n=3
    )


def q4_assigned_by_day(spark, sf_dir):
    return R.assigned_distance_by_period(
        S.event_incidents(spark, sf_dir), S.supplier_stations(spark, sf_dir), period="day", digits=DIGITS
    )


def q4_assigned_by_area(spark, sf_dir):
    return R.assigned_distance_by_area(S.event_incidents(spark, sf_dir), S.supplier_stations(spark, sf_dir), digits=DIGITS)


def q4_nearest_by_day(spark, sf_dir):
    return R.nearest_distance_by_period(
        S.event_incidents(spark, sf_dir), S.supplier_stations(spark, sf_dir), period="day", digits=DIGITS
    )


def q4_nearest_by_site(spark, sf_dir):
    return R.nearest_distance_by_site(S.event_incidents(spark, sf_dir), S.supplier_stations(spark, sf_dir), digits=DIGITS)


def q4_nearest_by_site_grid(spark, sf_dir):
    """Q4-2b from the incidents themselves, each with its nearest station by
    the descent, without counting them by place first; equals ``q4_nearest_by_site``."""
    found = R.nearest_stations(S.event_incidents(spark, sf_dir), S.supplier_stations(spark, sf_dir), search="descent")
    means = found.groupBy("AREA NAME").agg(F.round(F.avg("distance"), DIGITS).alias("avg(distance)"), F.count(F.lit(1)).alias("count"))
    return means.filter(F.col("AREA NAME").isNotNull())


def q4_nearest_many_sites(spark, sf_dir):
    """Q4-2b over many stations (a dense cluster and far ones), with repeated
    and null record numbers and incidents out of range."""
    return R.nearest_distance_by_site(
        S.scattered_incidents(spark, sf_dir), S.order_stations(spark, sf_dir), digits=DIGITS
    )


def q4_assigned_by_year(spark, sf_dir):
    return R.assigned_distance_by_period(
        S.dated_incidents(spark, sf_dir), S.supplier_stations(spark, sf_dir), period="year", digits=DIGITS
    )


def q4_nearest_by_year(spark, sf_dir):
    return R.nearest_distance_by_period(
        S.dated_incidents(spark, sf_dir), S.supplier_stations(spark, sf_dir), period="year", digits=DIGITS
    )


def q0_base_hashed(spark, sf_dir):
    """``q0_base`` with the whole-row DISTINCT that shuffles hashes first."""
    return R.base_dataset(deduplicate(typed_crimes(union_extracts(S.order_extracts(spark, sf_dir))), "hashed"))


def q0_csv_files(spark, sf_dir):
    """CSV files in two folders, under headers of another spelling and order."""
    return R.base_dataset(read_crimes(spark, S.csv_files(spark, sf_dir), dedupe=None))


def q0_malformed_lines(spark, sf_dir):
    """Lines of CSV files whose cells don't fit the header, by reason."""
    return malformed_lines(spark, S.spoilt_csv_files(spark, sf_dir)).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def q2_text_files(spark, sf_dir):
    """Text form over text files in two folders."""
    return R.street_parts_of_day_text(read_text_fields(spark, S.text_files(spark, sf_dir)))


def _placed(df: DataFrame) -> DataFrame:
    """``df`` (a small report) with the place of each row in its order."""
    return df.coalesce(1).withColumn("position", F.monotonically_increasing_id() + 1)


def q2_street_parts_ordered(spark, sf_dir):
    return _placed(q2_street_parts(spark, sf_dir))


def q4_assigned_by_area_ordered(spark, sf_dir):
    return _placed(q4_assigned_by_area(spark, sf_dir))


def q2_street_parts_partials(spark, sf_dir):
    """Q2 from states kept for each text file: the second update reads the
    second folder alone, the totals are those of all files."""
    first, second = S.text_files(spark, sf_dir)

    def rows(files):
        lines = spark.read.text(files).select(F.split("value", ",", -1).alias("f"), F.col("_metadata.file_path").alias("_file"))
        street = lines.filter(F.array_contains("f", R.STREET))
        hhmm = F.get("f", 3).try_cast("int")
        return street.select("_file", R.part_of_day(hhmm).alias("part of day"), F.lit(1).cast("long").alias("count"))

    states = Partials(spark, f"{checkpoint_dir(spark).rstrip('/')}/partials-{uuid.uuid4().hex}", ["part of day"], ["count"], rows)
    states.update([first])
    states.update([first, second])
    return states.totals()


def _catalogue(spark, sf_dir) -> C.Catalogue:
    made = C.Catalogue(spark, f"extracts_{uuid.uuid4().hex}_")
    made.income(S.nation_income(spark, sf_dir))
    made.table("geocode", S.customer_geocode(spark, sf_dir))
    return made


def q2_street_parts_sql(spark, sf_dir):
    made = _catalogue(spark, sf_dir)
    made.crimes(S.event_incidents(spark, sf_dir))
    return made.sql(C.STREET_PARTS_SQL, premise=R.STREET)


def q3_descent_extremes_sql(spark, sf_dir):
    made = _catalogue(spark, sf_dir)
    made.crimes(_base(spark, sf_dir))
    return made.sql(C.DESCENT_SQL, year=Q3_YEAR, n=3)


def q3_descent_near(spark, sf_dir):
    """Q3 with geocoded places that are a little off the incidents' coordinates."""
    return R.descent_in_income_extremes(
        _base(spark, sf_dir), S.shifted_geocode(spark, sf_dir), S.nation_income(spark, sf_dir), year=Q3_YEAR, n=3, tolerance=0.0004
    )


def q4_assigned_by_area_sql(spark, sf_dir):
    made = _catalogue(spark, sf_dir)
    fired = R.firearm_incidents(S.event_incidents(spark, sf_dir), extra=("AREA NAME",))
    sites = R.station_sites(S.supplier_stations(spark, sf_dir))
    made.table("assigned", assigned_site(fired, sites, "AREA", "AREA", "LAT", "LON", "Y", "X"))
    return made.sql(C.ASSIGNED_AREA_SQL, digits=DIGITS)


def entry(spark: SparkSession) -> DataFrame:
    return q1_top_months(spark, SMOKE_DIR)


def _corpus() -> tuple[dict, dict]:
    """Queries and SQL of the corpus operators, if that subpackage is there."""
    if importlib.util.find_spec("blotter.llm") is None:
        return {}, {}
    from blotter.llm import registry

    queries, sql = dict(registry.QUERIES), dict(registry.SQL)
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        queries["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "q0_base": q0_base,
        "q0_rows": q0_rows,
        "q0_csv_lines": q0_csv_lines,
        "q0_rejected_values": q0_rejected_values,
        "q1_top_months": q1_top_months,
        "q1_top_months_sql": q1_top_months_sql,
        "q1_top_months_view": q1_top_months_view,
        "q2_street_parts": q2_street_parts,
        "q2_street_parts_text": q2_street_parts_text,
        "q2_street_parts_csv": q2_street_parts_csv,
        "q2_street_parts_text_sets": q2_street_parts_text_sets,
        "q3_descent_extremes": q3_descent_extremes,
        "q4_assigned_by_day": q4_assigned_by_day,
        "q4_assigned_by_year": q4_assigned_by_year,
        "q4_assigned_by_area": q4_assigned_by_area,
        "q4_nearest_by_day": q4_nearest_by_day,
        "q4_nearest_by_year": q4_nearest_by_year,
        "q4_nearest_by_site": q4_nearest_by_site,
        "q4_nearest_by_site_grid": q4_nearest_by_site_grid,
        "q4_nearest_many_sites": q4_nearest_many_sites,
        "q0_base_hashed": q0_base_hashed,
        "q0_csv_files": q0_csv_files,
        "q0_malformed_lines": q0_malformed_lines,
        "q2_text_files": q2_text_files,
        "q2_street_parts_ordered": q2_street_parts_ordered,
        "q2_street_parts_partials": q2_street_parts_partials,
        "q2_street_parts_sql": q2_street_parts_sql,
        "q3_descent_extremes_sql": q3_descent_extremes_sql,
        "q3_descent_near": q3_descent_near,
        "q4_assigned_by_area_sql": q4_assigned_by_area_sql,
        "q4_assigned_by_area_ordered": q4_assigned_by_area_ordered,
        **_corpus()[0],
    }


# ------------------------------------------------------------------ oracle

_EXTRACTS = """
ext AS (
    SELECT * FROM orders WHERE coalesce(o_orderdate < TIMESTAMP '1999-01-01', true)
    UNION ALL
    SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
),
base AS (SELECT DISTINCT * FROM ext)
"""

_CUST_LAT = "(CAST(33.0 AS DOUBLE) + floor({k} / 1000) * CAST(0.001 AS DOUBLE))"
_CUST_LON = "(CAST(-118.0 AS DOUBLE) - ({k} % 1000) * CAST(0.001 AS DOUBLE))"
_OCCURRED = "(CAST(o_orderdate AS DATE) - CAST(dayofmonth(o_orderdate) AS INTEGER))"

_PART_OF_DAY = """
CASE WHEN h >= 500 AND h < 1200 THEN 'morning'
     WHEN h >= 1200 AND h < 1700 THEN 'afternoon'
     WHEN h >= 1700 AND h < 2100 THEN 'evening'
     ELSE 'night' END
"""

_STREET_PARTS = f"""
SELECT {_PART_OF_DAY} AS "part of day", count(*) AS "count"
FROM (SELECT hour(ts) * 100 + minute(ts) AS h FROM events WHERE event_type = 'click') t
GROUP BY 1
"""

# Incidents and stations of Q4, typed as the reports type them.
_Q4_INPUTS = """
inc AS (
    SELECT event_id,
           CAST(ts AS DATE) AS occ,
           CAST(user_id AS INTEGER) AS area,
           CASE WHEN event_type = 'signup' THEN NULL
                ELSE 'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS area_name,
           CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value * 4) AS INTEGER) END AS weapon,
           CAST(CASE WHEN event_type = 'error' THEN CAST(0.0 AS DOUBLE)
                ELSE CAST(33.7 AS DOUBLE) + ((minute(ts) * 60 + second(ts)) / CAST(3600.0 AS DOUBLE)) * CAST(0.6 AS DOUBLE)
                END AS REAL) AS lat,
           CAST(CASE WHEN event_type = 'error' THEN CAST(0.0 AS DOUBLE)
                ELSE CAST(-118.7 AS DOUBLE) + (((dayofmonth(ts) - 1) * 24 + hour(ts)) / CAST(744.0 AS DOUBLE)) * CAST(0.6 AS DOUBLE)
                END AS REAL) AS lon
    FROM events
),
fired AS (SELECT * FROM inc WHERE weapon BETWEEN 100 AND 199 AND lat <> 0),
st AS (
    SELECT CAST(s_suppkey AS INTEGER) AS site, s_name AS division,
           CAST(CAST(33.7 AS DOUBLE) + (s_suppkey % 21) * CAST(0.03 AS DOUBLE) AS REAL) AS y,
           CAST(CAST(-118.6 AS DOUBLE) + ((s_suppkey * 7) % 21) * CAST(0.02 AS DOUBLE) AS REAL) AS x
    FROM supplier
)
"""


def _rad(c: str) -> str:
    return f"(CAST({c} AS DOUBLE) * (pi() / 180.0))"


def _distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(({_rad(lat2)} - {_rad(lat1)}) / 2), 2)"
        f" + cos({_rad(lat1)}) * cos({_rad(lat2)}) * pow(sin(({_rad(lon2)} - {_rad(lon1)}) / 2), 2))"
    )
    return f"(6373.0 * (2.0 * atan2(sqrt({a}), sqrt(greatest(1.0 - {a}, 0.0)))))"


_NEAREST = f"""
pairs AS (
    SELECT f.event_id, s.site, s.division, {_distance('f.lat', 'f.lon', 's.y', 's.x')} AS d
    FROM fired f CROSS JOIN st s
),
best AS (
    SELECT event_id, division, CAST(d AS REAL) AS distance FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d, site) AS rk
        FROM pairs WHERE d < 1000.0
    ) t WHERE rk = 1
)
"""

_ASSIGNED_BY_EVENT = f"""
assigned AS (
    SELECT f.event_id, CAST({_distance('f.lat', 'f.lon', 's.y', 's.x')} AS REAL) AS distance
    FROM fired f JOIN st s ON f.area = s.site
)
"""

_ASSIGNED = f"""
assigned AS (
    SELECT f.occ, f.area_name, CAST({_distance('f.lat', 'f.lon', 's.y', 's.x')} AS REAL) AS distance
    FROM fired f JOIN st s ON f.area = s.site
)
"""


# Events as CSV lines: what the cells hold once parsed and typed.
_LINES = """
cells AS (
    SELECT event_id AS k, make_date(2015 + CAST(event_id AS INTEGER) % 3, CAST(month(ts) AS INTEGER),
                                    CAST(dayofmonth(ts) AS INTEGER) % 28 + 1) AS day,
           event_type, ts
    FROM events
)
"""

_MANY = f"""
scattered AS (
    SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value * 4) AS INTEGER) END AS weapon,
           CAST(CASE WHEN event_id % 5 = 0 THEN CAST(-70.0 AS DOUBLE) + (event_id % 1399) * CAST(0.1 AS DOUBLE)
                     WHEN event_type = 'error' THEN CAST(0.0 AS DOUBLE)
                     ELSE CAST(33.7 AS DOUBLE) + ((minute(ts) * 60 + second(ts)) / CAST(3600.0 AS DOUBLE)) * CAST(0.6 AS DOUBLE)
                END AS REAL) AS lat,
           CAST(CASE WHEN event_id % 5 = 0 THEN CAST(-179.0 AS DOUBLE) + ((event_id * 13) % 3571) * CAST(0.1 AS DOUBLE)
                     WHEN event_type = 'error' THEN CAST(0.0 AS DOUBLE)
                     ELSE CAST(-118.7 AS DOUBLE) + (((dayofmonth(ts) - 1) * 24 + hour(ts)) / CAST(744.0 AS DOUBLE)) * CAST(0.6 AS DOUBLE)
                END AS REAL) AS lon
    FROM events
),
shots AS (SELECT * FROM scattered WHERE weapon BETWEEN 100 AND 199 AND lat <> 0),
posts AS (
    SELECT CAST(o_orderkey AS INTEGER) AS site, 'Order#' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS division,
           CAST(CASE WHEN o_orderkey % 10 = 0 THEN CAST(-69.7 AS DOUBLE) + (o_orderkey % 1381) * CAST(0.1 AS DOUBLE)
                ELSE CAST(33.9 AS DOUBLE) + ((o_orderkey * 7919) % 9973) * CAST(0.00002 AS DOUBLE) END AS REAL) AS y,
           CAST(CASE WHEN o_orderkey % 10 = 0 THEN CAST(-179.5 AS DOUBLE) + ((o_orderkey * 7) % 3583) * CAST(0.1 AS DOUBLE)
                ELSE CAST(-118.4 AS DOUBLE) + ((o_orderkey * 6271) % 9941) * CAST(0.00002 AS DOUBLE) END AS REAL) AS x
    FROM orders
),
reach AS (
    SELECT f.event_id, p.site, p.division, {_distance('f.lat', 'f.lon', 'p.y', 'p.x')} AS d FROM shots f CROSS JOIN posts p
),
closest AS (
    SELECT event_id, min(d) AS d, arg_min(division, (d, site)) AS division FROM reach WHERE d < 1000.0 GROUP BY 1
)
"""

_NEAREST_BY_SITE = f"""
    WITH {_Q4_INPUTS}, {_NEAREST}
    SELECT division AS "AREA NAME",
           round(avg(CAST(distance AS DOUBLE)), {DIGITS}) AS "avg(distance)",
           count(*) AS "count"
    FROM best GROUP BY 1
"""


def oracle_sql() -> dict[str, str]:
    base_typed = f"""
        SELECT CAST(o_orderdate AS DATE) AS "Date Rptd",
               {_OCCURRED} AS "DATE OCC",
               CAST(floor(o_totalprice / 5000) AS INTEGER) AS "Vict Age",
               {_CUST_LAT.format(k='o_custkey')} AS "LAT",
               {_CUST_LON.format(k='o_custkey')} AS "LON"
        FROM base
    """
    monthly = """
        monthly AS (
            SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, count(*) AS c
            FROM base GROUP BY 1, 2
        ),
        picked AS (
            SELECT y, m, c, row_number() OVER (PARTITION BY y ORDER BY c DESC, m) AS pick FROM monthly
        )
    """
    q3 = f"""
        WITH {_EXTRACTS},
        crimes AS (
            SELECT {_OCCURRED} AS occ,
                   CASE WHEN o_orderstatus = 'P' THEN NULL
                        WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'W'
                        WHEN substr(o_orderpriority, 1, 1) = '2' THEN 'B'
                        WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'H'
                        WHEN substr(o_orderpriority, 1, 1) = '4' THEN 'K'
                        ELSE 'Z' END AS code,
                   {_CUST_LAT.format(k='o_custkey')} AS lat,
                   {_CUST_LON.format(k='o_custkey')} AS lon
            FROM base
        ),
        geo AS (
            SELECT {_CUST_LAT.format(k='c_custkey')} + {{shift}} AS lat, {_CUST_LON.format(k='c_custkey')} AS lon,
                   CAST(c_nationkey AS VARCHAR) AS zip
            FROM customer
        ),
        inc AS (
            SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS zip, CAST(m AS INTEGER) AS income
            FROM (SELECT c_nationkey, floor(avg(c_acctbal)) AS m FROM customer GROUP BY c_nationkey) x
            JOIN nation ON x.c_nationkey = nation.n_nationkey
        ),
        zips AS (
            (SELECT zip FROM inc WHERE income IS NOT NULL ORDER BY income DESC, zip LIMIT 3)
            UNION ALL
            (SELECT zip FROM inc WHERE income IS NOT NULL ORDER BY income ASC, zip LIMIT 3)
        ),
        places AS (SELECT lat, lon FROM geo JOIN zips ON geo.zip = zips.zip)
        SELECT CASE code WHEN 'W' THEN 'White' WHEN 'B' THEN 'Black' WHEN 'H' THEN 'Hispanic'
                         WHEN 'C' THEN 'Chinese' WHEN 'O' THEN 'Other' WHEN 'A' THEN 'Other Asian'
                         WHEN 'X' THEN 'Unknown' ELSE 'Error' END AS "Victim Descent",
               count(*) AS "#"
        FROM crimes JOIN places ON {{match}}
        WHERE occ >= DATE '{Q3_YEAR}-01-01' AND occ < DATE '{Q3_YEAR + 1}-01-01' AND code IS NOT NULL
        GROUP BY code
    """
    q3_exact = q3.format(shift="CAST(0.0 AS DOUBLE)", match="crimes.lat = places.lat AND crimes.lon = places.lon")
    csv_rows = f"""
            WITH {_LINES}
            SELECT CASE WHEN k % 11 = 0 THEN NULL ELSE day END AS "Date Rptd", day AS "DATE OCC",
                   CASE WHEN k % 13 = 0 OR k % 17 = 0 THEN NULL ELSE CAST(k % 90 AS INTEGER) END AS "Vict Age",
                   CASE WHEN event_type = 'error' THEN CAST(0.0 AS DOUBLE)
                        ELSE CAST(33.7 AS DOUBLE) + ((minute(ts) * 60 + second(ts)) / CAST(3600.0 AS DOUBLE)) * CAST(0.6 AS DOUBLE)
                   END AS "LAT",
                   CASE WHEN event_type = 'error' THEN CAST(0.0 AS DOUBLE)
                        ELSE CAST(-118.7 AS DOUBLE) + (((dayofmonth(ts) - 1) * 24 + hour(ts)) / CAST(744.0 AS DOUBLE)) * CAST(0.6 AS DOUBLE)
                   END AS "LON"
            FROM cells
        """
    area = f"""
        SELECT area_name AS "AREA NAME",
               round(avg(CAST(distance AS DOUBLE)), {DIGITS}) AS "avg(distance)",
               count(*) AS "count"
        FROM assigned WHERE area_name IS NOT NULL GROUP BY 1
    """
    return {
        "q0_base_hashed": f"WITH {_EXTRACTS} {base_typed}",
        "q0_malformed_lines": """
            SELECT CASE WHEN event_id % 19 = 0 THEN 'few cells' WHEN event_id % 23 = 0 THEN 'many cells' ELSE 'open quote' END AS reason,
                   count(*) AS lines
            FROM events WHERE event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0 GROUP BY 1
        """,
        "q2_text_files": _STREET_PARTS,
        "q2_street_parts_ordered": f"""
            SELECT *, row_number() OVER (ORDER BY "count" DESC, "part of day") AS "position" FROM ({_STREET_PARTS}) t
        """,
        "q2_street_parts_partials": f"""
            SELECT {_PART_OF_DAY} AS "part of day", CAST(count(*) AS BIGINT) AS "count"
            FROM (SELECT hour(ts) * 100 + minute(ts) AS h FROM events WHERE event_type = 'click') t GROUP BY 1
        """,
        "q2_street_parts_sql": _STREET_PARTS,
        "q3_descent_extremes_sql": q3_exact,
        "q3_descent_near": q3.format(
            shift="(c_custkey % 3 - 1) * CAST(0.0003 AS DOUBLE)",
            match="abs(crimes.lat - places.lat) <= CAST(0.0004 AS DOUBLE) AND abs(crimes.lon - places.lon) <= CAST(0.0004 AS DOUBLE)",
        ),
        "q4_assigned_by_area_sql": f"WITH {_Q4_INPUTS}, {_ASSIGNED} {area}",
        "q4_assigned_by_area_ordered": f"""
            WITH {_Q4_INPUTS}, {_ASSIGNED}, areas AS ({area})
            SELECT *, row_number() OVER (ORDER BY "count" DESC, "AREA NAME") AS "position" FROM areas
        """,
        "q0_base": f"WITH {_EXTRACTS} {base_typed}",
        "q0_rows": f'WITH {_EXTRACTS} SELECT count(*) AS "rows" FROM base',
        "q1_top_months": f"""
            WITH {_EXTRACTS}, {monthly}
            SELECT y AS "Year", m AS "Month", c AS "Total Crimes", CAST(pick AS INTEGER) AS "Top Number"
            FROM picked WHERE pick <= 3
        """,
        "q1_top_months_sql": f"""
            WITH {_EXTRACTS}, {monthly}
            SELECT y AS "Year", m AS "Month", c AS "TotalCrimes",
                   CAST(rank() OVER (PARTITION BY y ORDER BY c DESC) AS INTEGER) AS "Rank"
            FROM picked WHERE pick <= 3
        """,
        "q2_street_parts": _STREET_PARTS,
        "q2_street_parts_text": _STREET_PARTS,
        "q3_descent_extremes": q3_exact,
        "q4_assigned_by_day": f"""
            WITH {_Q4_INPUTS}, {_ASSIGNED}
            SELECT CAST(dayofmonth(occ) AS INTEGER) AS "day",
                   round(avg(CAST(distance AS DOUBLE)), {DIGITS}) AS "avg(distance)"
            FROM assigned GROUP BY 1
        """,
        "q4_assigned_by_area": f"""
            WITH {_Q4_INPUTS}, {_ASSIGNED}
            SELECT area_name AS "AREA NAME",
                   round(avg(CAST(distance AS DOUBLE)), {DIGITS}) AS "avg(distance)",
                   count(*) AS "count"
            FROM assigned WHERE area_name IS NOT NULL GROUP BY 1
        """,
        "q4_nearest_by_day": f"""
            WITH {_Q4_INPUTS}, {_NEAREST}
            SELECT CAST(dayofmonth(f.occ) AS INTEGER) AS "day",
                   round(avg(CAST(b.distance AS DOUBLE)), {DIGITS}) AS "avg(distance)"
            FROM fired f LEFT JOIN best b ON f.event_id = b.event_id GROUP BY 1
        """,
        "q0_csv_lines": csv_rows,
        "q0_csv_files": csv_rows,
        "q0_rejected_values": """
            SELECT count(*) FILTER (event_id % 11 = 0) AS "Date Rptd", CAST(0 AS BIGINT) AS "DATE OCC",
                   CAST(0 AS BIGINT) AS "TIME OCC", CAST(0 AS BIGINT) AS "AREA",
                   count(*) FILTER (event_id % 13 = 0) AS "Vict Age",
                   CAST(0 AS BIGINT) AS "LAT", CAST(0 AS BIGINT) AS "LON"
            FROM events
        """,
        "q1_top_months_view": f"""
            WITH {_EXTRACTS}, {monthly}
            SELECT y AS "Year", m AS "Month", c AS "TotalCrimes",
                   CAST(rank() OVER (PARTITION BY y ORDER BY c DESC) AS INTEGER) AS "Rank"
            FROM picked WHERE pick <= 3
        """,
        "q2_street_parts_csv": _STREET_PARTS,
        "q2_street_parts_text_sets": f"""
            SELECT {_PART_OF_DAY} AS "part of day", count(*) AS "count"
            FROM (SELECT hour(ts) * 100 + minute(ts) AS h FROM events WHERE event_type = 'click') t
            GROUP BY 1
        """,
        "q4_assigned_by_year": f"""
            WITH {_Q4_INPUTS}, {_ASSIGNED_BY_EVENT}
            SELECT CAST(2010 + event_id % 7 AS INTEGER) AS "year",
                   round(avg(CAST(distance AS DOUBLE)), {DIGITS}) AS "avg(distance)"
            FROM assigned GROUP BY 1
        """,
        "q4_nearest_by_year": f"""
            WITH {_Q4_INPUTS}, {_NEAREST}
            SELECT CAST(2010 + f.event_id % 7 AS INTEGER) AS "year",
                   round(avg(CAST(b.distance AS DOUBLE)), {DIGITS}) AS "avg(distance)"
            FROM fired f LEFT JOIN best b ON f.event_id = b.event_id GROUP BY 1
        """,
        "q4_nearest_many_sites": f"""
            WITH {_MANY}
            SELECT division AS "AREA NAME", round(avg(CAST(CAST(d AS REAL) AS DOUBLE)), {DIGITS}) AS "avg(distance)",
                   count(*) AS "count"
            FROM closest GROUP BY 1
        """,
        "q4_nearest_by_site": _NEAREST_BY_SITE,
        "q4_nearest_by_site_grid": _NEAREST_BY_SITE,
        **_corpus()[1],
    }
