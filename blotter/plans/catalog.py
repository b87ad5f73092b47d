"""SQL over the extracts: typed views with plain names, and parameterised text.

A catalogue registers each table as a temporary view whose columns have lower-case
names without blanks and the types of the reports (``date_rptd``, ``vict_age``).
The views are lazy: only columns and rows that a statement asks for are read and
typed. Statements take named arguments, which Spark binds as values.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.typed import ref
from blotter.functions.values import DAY_PARTS, DESCENT_LABELS, NIGHT, UNKNOWN_DESCENT, money_to_int
from blotter.plans import reports as R
from blotter.sources.extracts import typed_crimes
from blotter.sources.schemas import canonical


def plain_name(column: str) -> str:
    """``Date Rptd`` → ``date_rptd``."""
    return re.sub(r"[^a-z0-9]+", "_", canonical(column).lower()).strip("_")


class Catalogue:
    """Views of one session, all under a common prefix."""

    def __init__(self, spark: SparkSession, prefix: str = ""):
        self.spark, self.prefix = spark, prefix

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Registers ``df`` under plain column names as the view ``name``."""
        names = [plain_name(c) for c in df.columns]
        repeated = {n for n in names if names.count(n) > 1}
        if repeated:
            raise ValueError(f"columns with one plain name: {sorted(repeated)}")
        view = df.select(*[ref(c).alias(n) for c, n in zip(df.columns, names)])
        view.createOrReplaceTempView(self.prefix + name)
        return view

    def crimes(self, df: DataFrame, name: str = "crimes") -> DataFrame:
        """An extract, with the declared types."""
        return self.table(name, typed_crimes(df))

    def income(self, df: DataFrame, name: str = "income") -> DataFrame:
        """Incomes, with their money text as a number in ``income``."""
        return self.table(name, df.withColumn("income", money_to_int(ref("Estimated Median Income").cast("string"))))

    def stations(self, df: DataFrame, name: str = "stations") -> DataFrame:
        return self.table(name, R.station_sites(df))

    def sql(self, text: str, **arguments) -> DataFrame:
        """A statement over the views, which it names as ``{view}``; ``:name`` is an argument."""
        views = {n: self.prefix + n for n in re.findall(r"\{(\w+)\}", text)}
        return self.spark.sql(text.format(**views), args=arguments)


_PART_CASE = " ".join(f"WHEN time_occ >= {lo} AND time_occ < {hi} THEN '{label}'" for label, lo, hi in DAY_PARTS)

STREET_PARTS_SQL = f"""
SELECT CASE WHEN time_occ IS NULL THEN NULL {_PART_CASE} ELSE '{NIGHT}' END AS `part of day`, count(*) AS count
FROM {{crimes}} WHERE premis_desc = :premise GROUP BY 1 ORDER BY count DESC, `part of day`
"""

_LABEL_CASE = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in DESCENT_LABELS)

DESCENT_SQL = f"""
WITH incomes AS (
    SELECT DISTINCT trim(zip_code) AS zip, income FROM {{income}} WHERE income IS NOT NULL
), zips AS (
    (SELECT zip FROM incomes ORDER BY income DESC, zip LIMIT :n) UNION ALL (SELECT zip FROM incomes ORDER BY income, zip LIMIT :n)
), places AS (
    SELECT lat, lon FROM {{geocode}} g JOIN zips ON trim(g.zipcode) = zips.zip
), counted AS (
    SELECT lat, lon, vict_descent AS code, count(*) AS n FROM {{crimes}}
    WHERE date_occ >= make_date(:year, 1, 1) AND date_occ < make_date(:year + 1, 1, 1) AND vict_descent IS NOT NULL GROUP BY ALL
)
SELECT CASE code {_LABEL_CASE} ELSE '{UNKNOWN_DESCENT}' END AS `Victim Descent`, sum(n) AS `#`
FROM counted JOIN places USING (lat, lon) GROUP BY code ORDER BY `#` DESC, code
"""

ASSIGNED_AREA_SQL = """
SELECT area_name AS `AREA NAME`, round(avg(distance), :digits) AS `avg(distance)`, count(*) AS count
FROM {assigned} WHERE area_name IS NOT NULL GROUP BY area_name ORDER BY count DESC, `AREA NAME`
"""
