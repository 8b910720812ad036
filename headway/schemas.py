"""Explicit schemas; nothing in the package infers one."""

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_str, _long, _int, _double = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

# What the binaryFile source yields, and what the raw table holds per snapshot.
RAW_FILE = _struct(
    path=_str, modificationTime=T.TimestampType(), length=_long, content=T.BinaryType()
)

HEADER = _struct(gtfs_realtime_version=_str, timestamp=_long)

# Decoded entities keep wire names and wire presence: an absent parent is a null
# struct, an unset leaf is a null.  Projections apply names and defaults later.
TRIP_DESCRIPTOR = _struct(trip_id=_str, route_id=_str)
POSITION = _struct(latitude=_double, longitude=_double, bearing=_double, speed=_double)
STOP_TIME_EVENT = _struct(time=_long, delay=_int)
VEHICLE = _struct(
    trip=TRIP_DESCRIPTOR,
    vehicle=_struct(id=_str),
    position=POSITION,
    timestamp=_long,
    current_stop_sequence=_long,
    current_status=_int,
    stop_id=_str,
)
STOP_TIME = _struct(
    stop_sequence=_long, stop_id=_str, arrival=STOP_TIME_EVENT, departure=STOP_TIME_EVENT
)
TRIP_UPDATE = _struct(
    trip=TRIP_DESCRIPTOR, timestamp=_long, stop_time_update=T.ArrayType(STOP_TIME)
)
ENTITY = _struct(id=_str, vehicle=VEHICLE, trip_update=TRIP_UPDATE)
DECODED = _struct(header=HEADER, entities=T.ArrayType(ENTITY), decode_error=_str)

# Parsed snapshots as stored in JSON.  `stop_id` of a vehicle carries the
# current-status number there, and files of both kinds share one schema.
JSON_VEHICLE = _struct(
    id=_str,
    vehicle_id=_str,
    trip_id=_str,
    route_id=_str,
    position=POSITION,
    timestamp=_long,
    current_stop_sequence=_long,
    stop_id=_int,
)
JSON_TRIP = _struct(
    id=_str,
    trip_id=_str,
    route_id=_str,
    stop_time_updates=T.ArrayType(STOP_TIME),
    timestamp=_long,
)
JSON_SNAPSHOT = _struct(
    header=HEADER,
    vehicle_count=_long,
    vehicles=T.ArrayType(JSON_VEHICLE),
    trip_count=_long,
    trips=T.ArrayType(JSON_TRIP),
)

# Flat rows of the two record kinds.
VEHICLE_ROW = T.StructType(
    JSON_VEHICLE.fields[:-1]
    + [T.StructField("current_status", _int), T.StructField("stop_id", _str)]
)
TRIP_ROW = JSON_TRIP

FILE_LISTING = _struct(filename=_str, size=_long, modified=T.TimestampType())
