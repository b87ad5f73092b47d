"""The incident reports, as functions from DataFrames to a result DataFrame.

Inputs use the extracts' canonical column names (see ``blotter.sources``);
columns may be raw text (CSV) or already typed (parquet) — typing is chosen
per column when the plan is built. Results use the report column names.

| Report | Function |
|---|---|
| Q0 base dataset, its row count and schema; values that failed typing | ``base_dataset``, ``row_count``, ``schema_rows``, ``rejected_values`` |
| Q1 top months per year (DataFrame / SQL) | ``top_months``, ``top_months_sql`` |
| Q2 street incidents by part of day (columns / text lines) | ``street_parts_of_day``, ``street_parts_of_day_text`` |
| Q3 victims by descent in the richest and poorest areas | ``descent_in_income_extremes`` |
| Q4 firearm incidents: distance to the assigned / nearest site | ``assigned_distance_by_period``, ``assigned_distance_by_area``, ``nearest_distance_by_period``, ``nearest_distance_by_site`` |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.typed import as_date, as_double, as_float, as_int, as_text, in_date_range, ref
from blotter.functions.values import descent_label, money_to_int, part_of_day
from blotter.operators.key_filter import key_filter, passing, row_hash
from blotter.operators.near_keys import join_near
from blotter.operators.sites import assigned_site, nearest_site
from blotter.operators.topn import top_and_bottom_n, top_n_per_group

# Fixed values of the firearm reports: weapon codes 100-199 are firearms.
FIREARM_CODES = (100, 199)
STREET = "STREET"

_PERIODS = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def _rounded(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


# --------------------------------------------------------------------- Q0


def base_dataset(crimes: DataFrame) -> DataFrame:
    """Typed core columns of the (already de-duplicated) incident table."""
    return crimes.select(
        as_date(crimes, "Date Rptd").alias("Date Rptd"),
        as_date(crimes, "DATE OCC").alias("DATE OCC"),
        as_int(crimes, "Vict Age").alias("Vict Age"),
        as_double(crimes, "LAT").alias("LAT"),
        as_double(crimes, "LON").alias("LON"),
    )


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """One row, one column: the number of rows (partial counts, then a sum)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema of ``df`` as a table (name, type, nullable), in column order.

    Built from plan metadata on the driver; no data is read.
    """
    fields = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    table = df.sparkSession.createDataFrame(fields, "position int, name string, type string, nullable boolean")
    return table.orderBy("position").drop("position")


# Typed columns of the reports and their typing, for ``rejected_values``.
_TYPED = {
    "Date Rptd": as_date,
    "DATE OCC": as_date,
    "TIME OCC": as_int,
    "AREA": as_int,
    "Vict Age": as_int,
    "Weapon Used Cd": as_int,
    "LAT": as_double,
    "LON": as_double,
}


def rejected_values(crimes: DataFrame) -> DataFrame:
    """Per typed column, how many present values failed to parse (and so
    became null instead of failing the job). One row; one pass with partial
    counts. Blank text counts as absent, not rejected."""
    counts = []
    for name, typing in _TYPED.items():
        if name not in crimes.columns:
            continue
        present = F.length(F.trim(ref(name).cast("string"))) > 0
        counts.append(F.count(F.when(present & typing(crimes, name).isNull(), F.lit(1))).alias(name))
    return crimes.agg(*counts)


# --------------------------------------------------------------------- Q1


def top_months(crimes: DataFrame, n: int = 3, date_col: str = "Date Rptd") -> DataFrame:
    """The ``n`` months with most incidents in each year, numbered 1..n.

    Ties in the count are broken by the earlier month, so the result is
    deterministic. Columns: Year, Month, Total Crimes, Top Number.
    """
    dated = crimes.select(as_date(crimes, date_col).alias("_d"))
    monthly = dated.groupBy(F.year("_d").alias("Year"), F.month("_d").alias("Month")).agg(
        F.count(F.lit(1)).alias("Total Crimes")
    )
    return top_n_per_group(
        monthly, ["Year"], [F.desc("Total Crimes"), F.asc("Month")], n, rank="row_number", rank_col="Top Number"
    )


TOP_MONTHS_SQL = """
WITH monthly AS (
    SELECT year(d) AS Year, month(d) AS Month, count(*) AS TotalCrimes
    FROM {source}
    GROUP BY year(d), month(d)
), numbered AS (
    SELECT Year, Month, TotalCrimes,
           row_number() OVER (PARTITION BY Year ORDER BY TotalCrimes DESC, Month) AS pick
    FROM monthly
)
SELECT Year, Month, TotalCrimes,
       rank() OVER (PARTITION BY Year ORDER BY TotalCrimes DESC) AS Rank
FROM numbered
WHERE pick <= :n
"""


def top_months_sql(crimes: DataFrame, n: int = 3, date_col: str = "Date Rptd", view: str | None = None) -> DataFrame:
    """SQL form of ``top_months``: picks by row number, then reports the
    RANK among the picked rows (tied months share a rank).
    Columns: Year, Month, TotalCrimes, Rank.

    The typed dates (one column ``d``) are queried through a temporary view:
    ``view`` names it (it stays registered for other SQL); by default the
    DataFrame is bound to the statement without a lasting name.
    """
    dated = crimes.select(as_date(crimes, date_col).alias("d"))
    spark = crimes.sparkSession
    if view is not None:
        dated.createOrReplaceTempView(view)
        dated = spark.table(view)
    return spark.sql(TOP_MONTHS_SQL, args={"n": int(n)}, source=dated)


# --------------------------------------------------------------------- Q2


def _count_parts(parts: DataFrame) -> DataFrame:
    counted = parts.groupBy("part of day").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), F.asc("part of day"))


def street_parts_of_day(crimes: DataFrame) -> DataFrame:
    """Incidents whose premise is the street, counted by part of the day.

    Columns: ``part of day``, ``count``; most first.
    """
    street = crimes.filter(as_text(crimes, "Premis Desc") == STREET)
    return _count_parts(street.select(part_of_day(as_int(street, "TIME OCC")).alias("part of day")))


def street_parts_of_day_text(lines: DataFrame, time_field: int = 3) -> DataFrame:
    """Same report over naively split text lines (column ``fields``; the raw
    ``value``, when present, is used for an exact pre-filter).

    A line counts when *any* of its fields is exactly ``STREET``; its time is
    field ``time_field`` (0-based). A header line has no such field and drops
    out. Quoted separators shift fields, so prefer the column form on CSV.
    """
    kept = lines
    if "value" in lines.columns:
        # A field equal to STREET implies the raw line contains it: a cheap,
        # exact pre-filter that spares most lines the split.
        kept = kept.filter(F.col("value").contains(STREET))
    # One lambda reads the fields, so they are split once for a kept line. Other
    # lines are a null group, dropped by a condition on an aggregate: a filter
    # would be pushed below the projection and split the line again.
    hhmm = lambda f: F.trim(F.get(f, time_field)).try_cast("int")
    street = F.transform(
        F.array("fields"), lambda f: F.when(F.array_contains(f, STREET), F.struct(part_of_day(hhmm(f)).alias("part of day")))
    )
    counted = kept.select(street.alias("s")).select(F.get("s", 0).alias("s")).groupBy("s").agg(
        F.count(F.lit(1)).alias("count"), F.count("s").alias("_street")
    )
    out = counted.filter("_street > 0").select(F.col("s")["part of day"].alias("part of day"), "count")
    return out.orderBy(F.desc("count"), F.asc("part of day"))


# --------------------------------------------------------------------- Q3


def income_extreme_areas(income: DataFrame, n: int = 3, dedupe_keys: bool = False) -> DataFrame:
    """``ZIP Code`` of the ``n`` richest UNION ALL the ``n`` poorest areas.

    Income text such as ``$12,345`` is parsed; null incomes rank in neither
    list; ties at the cut go to the smaller ZIP code. UNION ALL keeps a ZIP in
    both lists twice (so its incidents count twice later) unless
    ``dedupe_keys``.
    """
    parsed = income.select(
        F.trim(as_text(income, "Zip Code")).alias("ZIP Code"),
        money_to_int(as_text(income, "Estimated Median Income")).alias("income"),
    ).distinct()
    picked = top_and_bottom_n(parsed, "income", n, tie_break=["ZIP Code"]).select("ZIP Code")
    return picked.distinct() if dedupe_keys else picked


def descent_in_income_extremes(
    crimes: DataFrame,
    geocode: DataFrame,
    income: DataFrame,
    year: int = 2015,
    n: int = 3,
    dedupe_keys: bool = False,
    date_col: str = "DATE OCC",
    tolerance: float | None = None,
    runtime_filter: bool = True,
) -> DataFrame:
    """Victims by descent among ``year``'s incidents located in the ``n``
    richest and ``n`` poorest ZIP codes. Columns: ``Victim Descent``, ``#``.

    Plan: the ZIP list (2n rows) first restricts the geocode table; incidents
    are pre-aggregated per (LAT, LON, descent) *before* the join, so a
    coordinate shared by a large share of incidents is one row when it meets
    the join; the counts are then summed. That equals counting the joined rows
    (inner joins keep the multiplicity of repeated geocode or ZIP rows). Codes
    are labelled after grouping, so each unknown code is its own ``Error`` row.

    Only the incidents at the places in question are grouped: their coordinates
    make a filter of bounded size that is applied where the incidents are read
    (``runtime_filter``). With a ``tolerance`` (degrees), an incident is at a
    place if neither coordinate differs by more; by default they are equal.
    """
    zips = income_extreme_areas(income, n, dedupe_keys)
    geo = geocode.select(
        as_double(geocode, "LAT").alias("LAT"),
        as_double(geocode, "LON").alias("LON"),
        F.trim(as_text(geocode, "ZIPcode")).alias("ZIP Code"),
    )
    places = geo.join(zips, "ZIP Code", "inner").select("LAT", "LON")

    in_year = crimes.filter(in_date_range(crimes, date_col, f"{year:04d}-01-01", f"{year + 1:04d}-01-01"))
    located = in_year.select(
        as_double(in_year, "LAT").alias("LAT"),
        as_double(in_year, "LON").alias("LON"),
        as_text(in_year, "Vict Descent").alias("code"),
    ).filter(F.col("code").isNotNull())
    if runtime_filter:
        located = _at_places(located, places, tolerance)
    per_place = located.groupBy("LAT", "LON", "code").agg(F.count(F.lit(1)).alias("n"))
    met = per_place.join(places, ["LAT", "LON"], "inner") if tolerance is None else join_near(per_place, places, ["LAT", "LON"], tolerance)
    per_code = met.groupBy("code").agg(F.sum("n").alias("#"))
    labelled = per_code.select(descent_label(F.col("code")).alias("Victim Descent"), "#", "code")
    return labelled.orderBy(F.desc("#"), F.asc("code")).drop("code")


def _at_places(located: DataFrame, places: DataFrame, tolerance: float | None) -> DataFrame:
    """The incidents that may be at one of the places: those whose coordinates,
    or with a tolerance the cells of that width, a filter of the places holds."""
    lat, lon = F.col("LAT"), F.col("LON")
    if tolerance is None:
        # -0.0 and 0.0 are equal, and are one hash
        own, theirs = [lat + 0.0, lon + 0.0], places.select((lat + 0.0).alias("LAT"), (lon + 0.0).alias("LON"))
    else:
        own = [F.floor(c / F.lit(float(tolerance))) for c in (lat, lon)]
        theirs = places.select(own[0].alias("LAT"), own[1].alias("LON"))
        for name in ("LAT", "LON"):
            theirs = theirs.withColumn(name, F.explode(F.array(F.col(name) - 1, F.col(name), F.col(name) + 1)))
    hashed = theirs.filter(lat.isNotNull() & lon.isNotNull()).select(row_hash([lat, lon]).alias("h"))
    return passing(located, row_hash(own), key_filter(hashed))


# --------------------------------------------------------------------- Q4


def firearm_incidents(crimes: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed firearm incidents away from the (0, 0) placeholder.

    ``Weapon Used Cd`` in 100..199 and ``LAT != 0`` (only LAT is tested; a
    null in either drops the row). Coordinates are 32-bit floats.
    """
    typed = crimes.select(
        as_date(crimes, "DATE OCC").alias("DATE OCC"),
        as_int(crimes, "AREA").alias("AREA"),
        as_float(crimes, "LAT").alias("LAT"),
        as_float(crimes, "LON").alias("LON"),
        as_int(crimes, "Weapon Used Cd").alias("weapon"),
        *[ref(c) for c in extra],
    )
    lo, hi = FIREARM_CODES
    return typed.filter(F.col("weapon").between(lo, hi) & (F.col("LAT") != 0)).drop("weapon")


def station_sites(stations: DataFrame) -> DataFrame:
    """Stations as sites: ``AREA`` (int), ``DIVISION``, ``Y`` = lat, ``X`` = lon (floats)."""
    return stations.select(
        as_int(stations, "PREC").alias("AREA"),
        as_text(stations, "DIVISION").alias("DIVISION"),
        as_float(stations, "Y").alias("Y"),
        as_float(stations, "X").alias("X"),
    )


def _period(period: str) -> Column:
    if period not in _PERIODS:
        raise ValueError(f"period must be one of {sorted(_PERIODS)}")
    return _PERIODS[period]("DATE OCC").alias(period)


def _mean_by(df: DataFrame, key: Column | str, key_name: str, digits: int | None, with_count: bool) -> DataFrame:
    """Mean distance per key, smallest first; or, ``with_count``, mean and
    count per non-null key, most incidents first.

    The null key is dropped by ``HAVING count(key) > 0`` rather than by a
    filter on the key: a filter on the key would be pushed below the
    projection that computes it and re-evaluate that (possibly costly)
    expression; a condition on an aggregate has to stay above the aggregate.
    """
    aggs = [_rounded(F.avg("distance"), digits).alias("avg(distance)")]
    if with_count:
        aggs += [F.count(F.lit(1)).alias("count"), F.count(key).alias("_keyed")]
    out = df.groupBy(key).agg(*aggs)
    if with_count:
        out = out.filter(F.col("_keyed") > 0).drop("_keyed")
        return out.orderBy(F.desc("count"), F.asc(f"`{key_name}`"))
    return out.orderBy(F.asc("avg(distance)"), F.asc(f"`{key_name}`"))


def assigned_distance_by_period(
    crimes: DataFrame, stations: DataFrame, period: str = "year", digits: int | None = None
) -> DataFrame:
    """Mean distance from firearm incidents to their area's station, per
    period of the occurrence date; smallest mean first.
    Columns: ``<period>``, ``avg(distance)``."""
    fired = firearm_incidents(crimes)
    joined = assigned_site(fired, station_sites(stations), "AREA", "AREA", "LAT", "LON", "Y", "X")
    return _mean_by(joined, _period(period), period, digits, with_count=False)


def assigned_distance_by_area(crimes: DataFrame, stations: DataFrame, digits: int | None = None) -> DataFrame:
    """Per incident ``AREA NAME``: mean distance to the assigned station and
    the number of incidents; most incidents first. A null area name is not a
    group. Columns: ``AREA NAME``, ``avg(distance)``, ``count``."""
    # The name is a raw column here, so the null group can go before the
    # join (a pushable IS NOT NULL) instead of only after the aggregate.
    fired = firearm_incidents(crimes, extra=("AREA NAME",)).filter(ref("AREA NAME").isNotNull())
    joined = assigned_site(fired, station_sites(stations), "AREA", "AREA", "LAT", "LON", "Y", "X")
    return _mean_by(joined, F.col("`AREA NAME`"), "AREA NAME", digits, with_count=True)


def nearest_stations(crimes: DataFrame, stations: DataFrame, max_km: float | None = 1000.0, search: str = "auto") -> DataFrame:
    """Firearm incidents with their nearest station (``AREA NAME`` = its
    division) and the distance; null when no station is within ``max_km``.
    ``search`` as in ``nearest_site``."""
    return _with_nearest(firearm_incidents(crimes), stations, max_km, search)


def _with_nearest(points: DataFrame, stations: DataFrame, max_km: float | None, search: str = "auto") -> DataFrame:
    found = nearest_site(
        points, station_sites(stations), "LAT", "LON", "AREA", "Y", "X", site_cols=("DIVISION",), max_km=max_km, site_key_as="site",
        search=search,
    )
    return found.withColumnRenamed("DIVISION", "AREA NAME")


def _mean_nearest(
    crimes: DataFrame, stations: DataFrame, key: str, of_point: Column | None, max_km: float | None, digits: int | None
) -> DataFrame:
    """Mean nearest distance and count by ``key``: of the incident
    (``of_point``) or of the station found. Incidents are counted by place (and
    key) first, so a hot place is one row in the search; a stream, which allows
    one aggregate, is searched row by row."""
    fired = firearm_incidents(crimes)
    own = [] if of_point is None else [of_point.alias(key)]
    rows = fired.select("LAT", "LON", *own)
    if rows.isStreaming:
        counted = rows.withColumn("n", F.lit(1).cast("long"))
    else:
        counted = rows.groupBy("LAT", "LON", *([] if of_point is None else [key])).agg(F.count(F.lit(1)).alias("n"))
    found = _with_nearest(counted, stations, max_km)
    if of_point is not None:
        found = found.drop("AREA NAME")
    seen = F.sum(F.when(F.col("distance").isNotNull(), F.col("n")))
    mean = F.sum(F.col("distance").cast("double") * F.col("n")) / seen
    name = ref(key)
    out = found.groupBy(name).agg(_rounded(mean, digits).alias("avg(distance)"), F.sum("n").alias("count"), F.count(name).alias("_keyed"))
    return out


def nearest_distance_by_period(
    crimes: DataFrame, stations: DataFrame, period: str = "year", max_km: float | None = 1000.0, digits: int | None = None
) -> DataFrame:
    """Mean distance to the nearest station per period; a period whose
    incidents have no station in range is kept with a null mean.
    Columns: ``<period>``, ``avg(distance)``; smallest mean first."""
    out = _mean_nearest(crimes, stations, period, _period(period), max_km, digits)
    return out.select(period, "avg(distance)").orderBy(F.asc("avg(distance)"), F.asc(f"`{period}`"))


def nearest_distance_by_site(
    crimes: DataFrame, stations: DataFrame, max_km: float | None = 1000.0, digits: int | None = None
) -> DataFrame:
    """Per nearest station: mean distance and incident count, most first.
    Incidents with no station in range are left out.
    Columns: ``AREA NAME``, ``avg(distance)``, ``count``."""
    out = _mean_nearest(crimes, stations, "AREA NAME", None, max_km, digits)
    # on the aggregate, so that it is not pushed below the search (see _mean_by)
    out = out.filter(F.col("_keyed") > 0).drop("_keyed")
    return out.orderBy(F.desc("count"), F.asc("`AREA NAME`"))
