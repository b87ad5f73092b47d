"""Declared column contracts of the incident extracts and their lookups.

The extracts are read with every column as text and typed afterwards with
``try_cast``-style expressions (see ``blotter.functions.typed``), so a bad
value becomes null instead of failing the job. Header names are matched after
normalisation (trimmed, case-folded, inner spaces collapsed), which absorbs
spelling drift between yearly files such as ``AREA `` versus ``AREA``.
"""

from __future__ import annotations

import re

# The public header of the city crime extracts, in file order.
# (The 2010-2019 file spells the fifth column "AREA " with a trailing space.)
CRIME_COLUMNS = (
    "DR_NO",
    "Date Rptd",
    "DATE OCC",
    "TIME OCC",
    "AREA",
    "AREA NAME",
    "Rpt Dist No",
    "Part 1-2",
    "Crm Cd",
    "Crm Cd Desc",
    "Mocodes",
    "Vict Age",
    "Vict Sex",
    "Vict Descent",
    "Premis Cd",
    "Premis Desc",
    "Weapon Used Cd",
    "Weapon Desc",
    "Status",
    "Status Desc",
    "Crm Cd 1",
    "Crm Cd 2",
    "Crm Cd 3",
    "Crm Cd 4",
    "LOCATION",
    "Cross Street",
    "LAT",
    "LON",
)

# Declared types of crime columns; the others are text. Extracts are brought to
# them before rows are compared, as files write equal values differently.
CRIME_TYPES = {
    **dict.fromkeys(("Date Rptd", "DATE OCC"), "date"),
    **dict.fromkeys(
        ("TIME OCC", "AREA", "Rpt Dist No", "Part 1-2", "Crm Cd", "Vict Age", "Premis Cd", "Weapon Used Cd",
         "Crm Cd 1", "Crm Cd 2", "Crm Cd 3", "Crm Cd 4"),
        "int",
    ),
    **dict.fromkeys(("LAT", "LON"), "double"),
}

# Columns of the lookup extracts that the reports use.
STATION_COLUMNS = ("X", "Y", "FID", "DIVISION", "LOCATION", "PREC")
GEOCODE_COLUMNS = ("LAT", "LON", "ZIPcode")
INCOME_COLUMNS = ("Zip Code", "Community", "Estimated Median Income")

# Declared schemas of the benchmark tables the stand-ins read
# (DDL form). Declaring them skips the footer read of schema inference.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Canonical names the reports use, keyed by their normalised spelling.
_CANONICAL = {
    name.strip().lower(): name.strip()
    for name in CRIME_COLUMNS + STATION_COLUMNS + GEOCODE_COLUMNS + INCOME_COLUMNS
}


def normalise(name: str) -> str:
    """Key used to match a header cell against the declared columns."""
    return re.sub(r"\s+", " ", name.strip()).lower()


def canonical(name: str) -> str:
    """The declared spelling of ``name``; unknown headers are only trimmed."""
    return _CANONICAL.get(normalise(name), re.sub(r"\s+", " ", name.strip()))


def crime_text_schema():
    """All-text positional schema of a crime extract (for header-less files)."""
    from pyspark.sql.types import StringType, StructField, StructType

    return StructType([StructField(c, StringType(), True) for c in CRIME_COLUMNS])
