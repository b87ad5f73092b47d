"""Report plans and the benchmark stand-ins that feed them."""

from blotter.plans.reports import (
    assigned_distance_by_area,
    assigned_distance_by_period,
    base_dataset,
    descent_in_income_extremes,
    firearm_incidents,
    income_extreme_areas,
    nearest_distance_by_period,
    nearest_distance_by_site,
    nearest_stations,
    rejected_values,
    row_count,
    schema_rows,
    street_parts_of_day,
    street_parts_of_day_text,
    top_months,
    top_months_sql,
)

__all__ = [
    "assigned_distance_by_area",
    "assigned_distance_by_period",
    "base_dataset",
    "descent_in_income_extremes",
    "firearm_incidents",
    "income_extreme_areas",
    "nearest_distance_by_period",
    "nearest_distance_by_site",
    "nearest_stations",
    "rejected_values",
    "row_count",
    "schema_rows",
    "street_parts_of_day",
    "street_parts_of_day_text",
    "top_months",
    "top_months_sql",
]
