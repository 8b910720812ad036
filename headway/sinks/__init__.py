"""Writers for raw and parsed snapshots, and where they go."""

from headway.sinks.files import write_files
from headway.sinks.tables import with_day, write_daily, write_parsed
from headway.sinks.target import storage_target

__all__ = ["storage_target", "with_day", "write_daily", "write_files", "write_parsed"]
