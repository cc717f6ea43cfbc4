"""Readers of trip and zone data, and checks on the sources."""

from farebox.sources.checks import (
    MissingSource,
    freshness,
    missing_month_files,
    missing_months,
    preview,
    profile,
    require_month_file,
)
from farebox.sources.trips import ingest, list_files, read_trips, registered_table
from farebox.sources.zones import read_zones

__all__ = [
    "MissingSource",
    "freshness",
    "ingest",
    "list_files",
    "missing_month_files",
    "missing_months",
    "preview",
    "profile",
    "read_trips",
    "read_zones",
    "registered_table",
    "require_month_file",
]
