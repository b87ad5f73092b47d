"""Column functions (Column → Column); all native, none runs Python per row."""

from blotter.functions.geo import EARTH_RADIUS_KM, haversine_km, to_float32
from blotter.functions.typed import as_date, as_double, as_float, as_int, as_text, ref, us_date_text
from blotter.functions.values import (
    DAY_PARTS,
    DESCENT_LABELS,
    descent_label,
    hhmm_of,
    money_to_int,
    part_of_day,
)

__all__ = [
    "DAY_PARTS",
    "DESCENT_LABELS",
    "EARTH_RADIUS_KM",
    "as_date",
    "as_double",
    "as_float",
    "as_int",
    "as_text",
    "descent_label",
    "haversine_km",
    "hhmm_of",
    "money_to_int",
    "part_of_day",
    "ref",
    "to_float32",
    "us_date_text",
]
