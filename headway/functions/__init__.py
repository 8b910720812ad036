"""Column functions.  All are built-in expressions; none is a UDF."""

from headway.functions.feeds import feed_status, feed_type_of
from headway.functions.names import direction_name, route_name, stop_name
from headway.functions.times import (
    day_folder,
    epoch_seconds,
    format_epoch,
    snapshot_epoch,
    snapshot_filename,
    snapshot_kind,
    timestamp_readable,
)
from headway.functions.trip_ids import departure_time, parse_trip_id

__all__ = [
    "day_folder",
    "departure_time",
    "direction_name",
    "epoch_seconds",
    "feed_status",
    "feed_type_of",
    "format_epoch",
    "parse_trip_id",
    "route_name",
    "snapshot_epoch",
    "snapshot_filename",
    "snapshot_kind",
    "stop_name",
    "timestamp_readable",
]
