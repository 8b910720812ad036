"""Vehicle positions: filter, projection and interpretation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import route_name, stop_name, timestamp_readable
from headway.functions.trip_ids import TRIP_FIELDS, split_trip_id, trip_fields
from headway.lookups import FIRST_VEHICLES

def under(parent: Column, leaf: str, default: object) -> Column:
    """A leaf below an optional parent: null without the parent, else its default if unset."""
    return F.when(parent.isNotNull(), F.coalesce(parent[leaf], F.lit(default)))


def vehicle_fields(entity_id: Column, vehicle: Column) -> dict[str, Column]:
    """The fields of a vehicle record.  Its own leaves stay null when unset."""
    position = F.struct(
        *[
            under(vehicle["position"], leaf, 0.0).alias(leaf)
            for leaf in ("latitude", "longitude", "bearing", "speed")
        ]
    )
    return {
        "id": F.coalesce(entity_id, F.lit("")),
        "vehicle_id": under(vehicle["vehicle"], "id", ""),
        "trip_id": under(vehicle["trip"], "trip_id", ""),
        "route_id": under(vehicle["trip"], "route_id", ""),
        "position": position,
        "timestamp": vehicle["timestamp"],
        "current_stop_sequence": vehicle["current_stop_sequence"],
        "current_status": vehicle["current_status"],
        "stop_id": vehicle["stop_id"],
    }


def with_vehicle(entities: DataFrame) -> DataFrame:
    """Entities that carry a vehicle."""
    return entities.filter(F.col("vehicle").isNotNull())


def project_vehicles(entities: DataFrame, *keys: str) -> DataFrame:
    """Entity rows to vehicle rows."""
    fields = vehicle_fields(F.col("id"), F.col("vehicle"))
    return with_vehicle(entities).select(
        *keys, *[value.alias(name) for name, value in fields.items()]
    )


def interpret_vehicles(vehicles: DataFrame) -> DataFrame:
    """All input columns plus ``route_name``, ``trip_info`` and ``timestamp_readable``.

    Null, empty and missing inputs add nothing.  The pieces of the trip id are columns
    of an inner projection, so each is computed once per row.
    """

    def given(name: str, kind: str) -> Column:
        return F.col(name) if name in vehicles.columns else F.lit(None).cast(kind)

    trip_id, route_id = given("trip_id", "string"), given("route_id", "string")
    cut = split_trip_id(trip_id)
    staged = vehicles.select("*", *[piece.alias(f"_{name}") for name, piece in cut.items()])
    fields = trip_fields(trip_id, {name: F.col(f"_{name}") for name in cut})
    info = F.struct(*[fields[name].alias(name) for name in TRIP_FIELDS])
    return staged.select(
        *vehicles.columns,
        F.when(route_id != "", route_name(route_id)).alias("route_name"),
        F.when(trip_id != "", info).alias("trip_info"),
        timestamp_readable(given("timestamp", "bigint")).alias("timestamp_readable"),
    )


def with_route_names(vehicles: DataFrame, routes: DataFrame) -> DataFrame:
    """``route_name`` by joining the route dimension, which has one row per route (26)."""
    named = routes.select("route_id", F.col("route_name").alias("_known"))
    joined = vehicles.join(F.broadcast(named), "route_id", "left")
    fallback = F.concat(F.lit("Route "), F.col("route_id"))
    return joined.select(
        *vehicles.columns,
        F.when(F.col("route_id") != "", F.coalesce("_known", fallback)).alias("route_name"),
    )


def with_stop_names(df: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """``stop_name`` for each ``stop_id``, from an optional stops dimension.

    The dimension may be of any size, so there is no broadcast hint: Spark
    broadcasts it when its size allows and else splits hot stops of the left side.
    A repeated stop keeps one name, as a lookup must not multiply rows.
    """
    if stops is None:
        return df.withColumn("stop_name", stop_name(F.col("stop_id")))
    # Grouping by the reversed id leaves the join a shuffle of its own on both sides.
    # Adaptive execution splits a hot key only where the join reads its shuffles
    # directly, which an aggregation by the join key itself would prevent.
    named = (
        stops.groupBy(F.reverse("stop_id"))
        .agg(F.min("stop_id").alias("stop_id"), F.min("stop_name").alias("_known"))
        .select("stop_id", "_known")
    )
    joined = df.join(named, "stop_id", "left")
    return joined.select(
        *df.columns, stop_name(F.col("stop_id"), F.col("_known")).alias("stop_name")
    )


def first_vehicles(vehicles: DataFrame, feed: str, *order: str) -> DataFrame:
    """The first 50 vehicles of each snapshot.

    The rank filter becomes a ``WindowGroupLimit`` in front of the shuffle, so a task
    sends at most 50 rows per snapshot however many it holds.
    """
    rank = F.row_number().over(Window.partitionBy(feed).orderBy(*order))
    return (
        vehicles.withColumn("_rank", rank).filter(F.col("_rank") <= FIRST_VEHICLES).drop("_rank")
    )
