"""Sources: declared schemas and readers."""

from blotter.sources.extracts import (
    by_header,
    deduplicate,
    distinct_by_hash,
    headers,
    malformed_lines,
    parse_lines,
    read_crimes,
    read_csv_text,
    read_lookup,
    read_table,
    read_text_fields,
    typed_crimes,
    union_extracts,
)
from blotter.sources.schemas import CRIME_COLUMNS, canonical, crime_text_schema, normalise

__all__ = [
    "CRIME_COLUMNS",
    "by_header",
    "canonical",
    "crime_text_schema",
    "deduplicate",
    "distinct_by_hash",
    "headers",
    "malformed_lines",
    "normalise",
    "parse_lines",
    "read_crimes",
    "read_csv_text",
    "read_lookup",
    "read_table",
    "read_text_fields",
    "typed_crimes",
    "union_extracts",
]
