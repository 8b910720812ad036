"""Continuous and one-shot ingestion."""

from headway.streaming.ingest import (
    compact_day,
    ingest_snapshots,
    read_ingested,
    stream_vehicles,
)
from headway.streaming.progress import life_totals, log_progress, read_progress, stop_logging
from headway.streaming.status import status_frame, status_totals
from headway.streaming.supervise import supervise
from headway.streaming.triggers import once, poll_every

__all__ = [
    "compact_day",
    "ingest_snapshots",
    "life_totals",
    "log_progress",
    "once",
    "poll_every",
    "read_ingested",
    "read_progress",
    "status_frame",
    "status_totals",
    "stop_logging",
    "stream_vehicles",
    "supervise",
]
