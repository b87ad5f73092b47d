"""Typing of raw columns: text from CSV, or already typed columns from parquet.

Each helper looks at the column's current type when the plan is built (a
driver-side schema lookup, no data) and emits the cheapest native expression:
already typed input passes through a plain cast, text is parsed with
null-on-failure functions so a bad value never fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType


def ref(name: str) -> Column:
    """Column by exact name, safe for names with spaces or dots."""
    return F.col(f"`{name}`")


def _type_of(df: DataFrame, name: str):
    return df.schema[name].dataType


def us_date_text(text: Column) -> Column:
    """``M/D/YYYY[ time]`` text → date, time of day discarded; bad text → null.

    Only the part before the first space is parsed, padded or not, matching
    a split on ``/`` that drops whatever follows the year. ISO text
    (``YYYY-MM-DD[ time]``, what a typed date or timestamp becomes as text) is
    accepted too; the two forms cannot be confused (slashes vs dashes).
    """
    day = F.substring_index(F.trim(text), " ", 1)
    return F.coalesce(F.try_to_date(day, "M/d/yyyy"), F.try_to_date(day, "yyyy-M-d"))


def as_date(df: DataFrame, name: str) -> Column:
    dtype = _type_of(df, name)
    if isinstance(dtype, StringType):
        return us_date_text(ref(name))
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        return F.to_date(ref(name))
    return ref(name).try_cast("date")


def as_number(df: DataFrame, name: str, type_name: str) -> Column:
    """Numeric typing; text is trimmed first, unparsable text becomes null."""
    dtype = _type_of(df, name)
    if isinstance(dtype, StringType):
        return F.trim(ref(name)).try_cast(type_name)
    return ref(name).try_cast(type_name)


def as_int(df: DataFrame, name: str) -> Column:
    """Whole numbers; text may write them with a decimal part (``101.0``)."""
    whole = as_number(df, name, "int")
    if isinstance(_type_of(df, name), StringType):
        wide = as_number(df, name, "double")
        whole = F.coalesce(whole, F.when(wide == F.floor(wide), wide.try_cast("int")))
    return whole


def as_float(df: DataFrame, name: str) -> Column:
    """32-bit float: coordinates and distances are rounded to it on purpose."""
    return as_number(df, name, "float")


def as_double(df: DataFrame, name: str) -> Column:
    return as_number(df, name, "double")


def as_text(df: DataFrame, name: str) -> Column:
    return ref(name).cast("string")


def in_date_range(df: DataFrame, name: str, start: str, end: str) -> Column:
    """``start <= date(name) < end`` (ISO dates), written so a typed column
    keeps the comparison on the raw column: parquet can then skip row groups
    and partitions (``PushedFilters``). Text must be parsed first, so for text
    the comparison is on the parsed date."""
    dtype = _type_of(df, name)
    if isinstance(dtype, DateType):
        return (ref(name) >= F.lit(start).cast("date")) & (ref(name) < F.lit(end).cast("date"))
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        kind = "timestamp_ntz" if isinstance(dtype, TimestampNTZType) else "timestamp"
        return (ref(name) >= F.lit(start).cast(kind)) & (ref(name) < F.lit(end).cast(kind))
    day = as_date(df, name)
    return (day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date"))
