"""Trip ids: ``<departure>_<route>..<direction><destination>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.names import direction_name, route_name
from headway.lookups import BAD_ROUTE_DIRECTION, BAD_TRIP_ID

TRIP_FIELDS = (
    "raw",
    "departure_time",
    "route_id",
    "route_name",
    "direction",
    "direction_code",
    "destination_code",
    "error",
)


def departure_time(digits: Column) -> Column:
    """``HH:MM:SS`` cut from the first six characters; shorter text stays as it is."""
    return F.when(
        F.length(digits) >= 6,
        F.concat(
            F.substring(digits, 1, 2),
            F.lit(":"),
            F.substring(digits, 3, 2),
            F.lit(":"),
            F.substring(digits, 5, 2),
        ),
    ).otherwise(digits)


def split_trip_id(trip_id: Column) -> dict[str, Column]:
    """Cut a trip id into its departure, route and tail, and name what is wrong with it.

    ``substring_index`` from the left finds the first separator only, and the tail
    starts behind it, so runs of dots split left to right without overlap.  The pieces
    of a faulty id are null, and so is all that is made from them.
    """
    has_parts = F.contains(trip_id, F.lit(".")) & F.contains(trip_id, F.lit("_"))
    second = F.substring_index(F.substring_index(trip_id, "_", 2), "_", -1)
    has_direction = F.contains(second, F.lit(".."))
    body = F.when(has_parts & has_direction, second)
    route = F.substring_index(body, "..", 1)
    return {
        "departure": F.when(body.isNotNull(), F.substring_index(trip_id, "_", 1)),
        "route": route,
        "tail": F.substring_index(F.substr(body, F.length(route) + 3), "..", 1),
        "error": F.when(~F.coalesce(has_parts, F.lit(False)), BAD_TRIP_ID).when(
            ~has_direction, BAD_ROUTE_DIRECTION
        ),
    }


def trip_fields(raw: Column, cut: dict[str, Column]) -> dict[str, Column]:
    """The eight output fields from the pieces of :func:`split_trip_id`."""
    tail = cut["tail"]
    code = F.when(tail != "", F.substring(tail, 1, 1))
    return {
        "raw": raw,
        "departure_time": departure_time(cut["departure"]),
        "route_id": cut["route"],
        "route_name": route_name(cut["route"]),
        "direction": direction_name(code),
        "direction_code": code,
        "destination_code": F.when(F.length(tail) > 1, F.substr(tail, F.lit(2))),
        "error": cut["error"],
    }


def parse_trip_id(trip_id: Column) -> Column:
    """One struct with the parsed fields, or with ``error`` set and the rest null."""
    fields = trip_fields(trip_id, split_trip_id(trip_id))
    return F.struct(*[fields[name].alias(name) for name in TRIP_FIELDS])
