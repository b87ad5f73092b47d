"""Value functions of the reports, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Victim descent codes and their labels; any other code is "Error".
DESCENT_LABELS = (
    ("W", "White"),
    ("B", "Black"),
    ("H", "Hispanic"),
    ("C", "Chinese"),
    ("O", "Other"),
    ("A", "Other Asian"),
    ("X", "Unknown"),
)
UNKNOWN_DESCENT = "Error"

# Parts of the day by HHMM clock value, [start, end) bounds;
# everything else (2100-0459) is "night".
DAY_PARTS = (
    ("morning", 500, 1200),
    ("afternoon", 1200, 1700),
    ("evening", 1700, 2100),
)
NIGHT = "night"


def money_to_int(text: Column) -> Column:
    """``$12,345`` → 12345. Dollar signs and thousands separators are removed
    by pattern (not by position); anything still not an integer → null."""
    return F.regexp_replace(F.trim(text), r"[$,]", "").try_cast("int")


def descent_label(code: Column) -> Column:
    """Descent code → label; unknown codes (and null) → ``Error``."""
    expr = None
    for key, label in DESCENT_LABELS:
        expr = (F.when(code == key, label) if expr is None else expr.when(code == key, label))
    return expr.otherwise(UNKNOWN_DESCENT)


def part_of_day(hhmm: Column) -> Column:
    """HHMM clock value (int, e.g. 459 for 04:59) → part of the day.

    The value is a clock reading, not minutes since midnight. Null in → null
    out (the row is not silently counted as night).
    """
    expr = None
    for label, lo, hi in DAY_PARTS:
        cond = (hhmm >= lo) & (hhmm < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(hhmm.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(NIGHT))


def hhmm_of(ts: Column) -> Column:
    """Clock value HHMM of a timestamp, as an int."""
    return F.hour(ts) * 100 + F.minute(ts)
