"""Trip updates: projection, nested stop times and their flat form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.operators.vehicles import under

def stop_time_event(event: Column) -> Column:
    """Arrival or departure: null when absent, and 0 for each unset leaf when present."""
    return F.when(
        event.isNotNull(),
        F.struct(
            *[
                F.coalesce(event[leaf], F.lit(0)).alias(leaf) for leaf in ("time", "delay")
            ]
        ),
    )


def stop_time(update: Column) -> Column:
    """One stop-time update with defaults filled in."""
    return F.struct(
        update["stop_sequence"].alias("stop_sequence"),
        update["stop_id"].alias("stop_id"),
        stop_time_event(update["arrival"]).alias("arrival"),
        stop_time_event(update["departure"]).alias("departure"),
    )


def trip_update_fields(entity_id: Column, update: Column) -> dict[str, Column]:
    """The fields of a trip record; no stop times give an empty array."""
    return {
        "id": F.coalesce(entity_id, F.lit("")),
        "trip_id": under(update["trip"], "trip_id", ""),
        "route_id": under(update["trip"], "route_id", ""),
        "stop_time_updates": F.coalesce(
            F.transform(update["stop_time_update"], stop_time), F.expr("filter(array(), x -> true)")
        ),
        "timestamp": update["timestamp"],
    }


def with_trip_update(entities: DataFrame) -> DataFrame:
    """Entities that carry a trip update."""
    return entities.filter(F.col("trip_update").isNotNull())


def project_trips(entities: DataFrame, *keys: str) -> DataFrame:
    """Entity rows to trip rows with a nested array of stop times."""
    fields = trip_update_fields(F.col("id"), F.col("trip_update"))
    return with_trip_update(entities).select(
        *keys, *[value.alias(name) for name, value in fields.items()]
    )


def explode_stop_times(trips: DataFrame) -> DataFrame:
    """One row per stop-time update; a trip without any keeps one row with a null position."""
    kept = [name for name in trips.columns if name != "stop_time_updates"]
    return trips.select(
        *kept, F.posexplode_outer("stop_time_updates").alias("stop_pos", "_update")
    ).select(
        *kept,
        "stop_pos",
        "_update.stop_sequence",
        "_update.stop_id",
        F.col("_update.arrival.time").alias("arrival_time"),
        F.col("_update.arrival.delay").alias("arrival_delay"),
        F.col("_update.departure.time").alias("departure_time"),
        F.col("_update.departure.delay").alias("departure_delay"),
    )
