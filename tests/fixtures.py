"""Hand-made CSV extracts for the trap tests (one small file per case)."""

from __future__ import annotations

import csv
import io
import math

import numpy as np

from blotter.sources.schemas import CRIME_COLUMNS

STATION_HEADER = ["X", "Y", "FID", "DIVISION", "LOCATION", "PREC"]


def crime_csv(rows: list[dict], area_header: str = "AREA ") -> str:
    """A crime extract with the full header; unspecified fields are blank."""
    header = [area_header if c == "AREA" else c for c in CRIME_COLUMNS]
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(header)
    for r in rows:
        w.writerow(["" if r.get(c) is None else r.get(c) for c in CRIME_COLUMNS])
    return buf.getvalue()


def table_csv(header: list[str], rows: list[list]) -> str:
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(header)
    for r in rows:
        w.writerow(["" if v is None else v for v in r])
    return buf.getvalue()


def f32(x: float) -> float:
    return float(np.float32(x))


def ref_distance(lat1, lon1, lat2, lon2, r=6373.0) -> float:
    """Distance as the reports compute it: 32-bit inputs, double math, 32-bit result."""
    lat1, lon1, lat2, lon2 = (f32(v) for v in (lat1, lon1, lat2, lon2))
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dphi, dlam = p2 - p1, math.radians(lon2) - math.radians(lon1)
    a = math.sin(dphi / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dlam / 2) ** 2
    return f32(r * (2 * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0.0)))))
