"""Readers for raw snapshots, parsed snapshots, listings and dimensions."""

from headway.sources.dimensions import read_stops, routes
from headway.sources.listing import list_days, list_snapshots
from headway.sources.parsed import read_parsed
from headway.sources.raw import read_raw, read_raw_stream

__all__ = [
    "list_days",
    "list_snapshots",
    "read_parsed",
    "read_raw",
    "read_raw_stream",
    "read_stops",
    "routes",
]
