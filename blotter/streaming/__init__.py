"""Streaming runs of the reports over a growing directory of extracts."""

from blotter.streaming.extracts import read_crime_stream, start_report

__all__ = ["read_crime_stream", "start_report"]
