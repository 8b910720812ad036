"""Whole snapshots: counts, parsed form, listing order and the union of both kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.lookups import FIRST_VEHICLES, LATEST_FILES, TRIP_UPDATES, VEHICLE_POSITIONS
from headway.operators.trips import trip_update_fields
from headway.operators.vehicles import interpret_vehicles, vehicle_fields


def count_by_feed(rows: DataFrame, feed: str, name: str) -> DataFrame:
    """Rows per snapshot, partially counted in front of the shuffle."""
    return rows.groupBy(feed).agg(F.count("*").alias(name))


def _parsed_vehicle(entity: Column) -> Column:
    fields = vehicle_fields(entity["id"], entity["vehicle"])
    # Stored snapshots carry the status number under the name `stop_id`.
    fields["stop_id"] = fields.pop("current_status")
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _parsed_trip(entity: Column) -> Column:
    fields = trip_update_fields(entity["id"], entity["trip_update"])
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _parsed(good: DataFrame, keys: tuple, payload: str, count: str, rows: str, shape) -> DataFrame:
    carrying = F.filter("entities", lambda entity: entity[payload].isNotNull())
    nested = good.select(*keys, "header", F.transform(carrying, shape).alias(rows))
    return nested.select(*keys, "header", F.size(rows).cast("bigint").alias(count), rows)


def parsed_vehicle_snapshots(good: DataFrame, *keys: str) -> DataFrame:
    """Decoded snapshots in the stored JSON shape: header, count and nested vehicles."""
    return _parsed(good, keys, "vehicle", "vehicle_count", "vehicles", _parsed_vehicle)


def parsed_trip_snapshots(good: DataFrame, *keys: str) -> DataFrame:
    """Decoded snapshots in the stored JSON shape: header, count and nested trips."""
    return _parsed(good, keys, "trip_update", "trip_count", "trips", _parsed_trip)


def interpret_snapshots(parsed: DataFrame, *keys: str) -> DataFrame:
    """The first 50 vehicles of each stored snapshot, interpreted, next to its full count.

    The cut comes first, so no vehicle beyond it is interpreted.  A snapshot with an empty
    list keeps one row, with a count of 0 and no vehicle.  Snapshots without ``vehicles``
    yield no rows; see :func:`without_vehicles`.
    """
    first = parsed.filter(F.col("vehicles").isNotNull()).select(
        *keys,
        F.size("vehicles").cast("bigint").alias("total_vehicles"),
        F.posexplode_outer(F.slice("vehicles", 1, FIRST_VEHICLES)).alias("entity_pos", "_vehicle"),
    )
    return interpret_vehicles(first.select(*keys, "total_vehicles", "entity_pos", "_vehicle.*"))


def without_vehicles(parsed: DataFrame) -> DataFrame:
    """Stored snapshots that interpretation returns as they are; malformed ones are none."""
    bare = parsed.filter(F.col("vehicles").isNull())
    return bare.filter("status = 'ok'") if "status" in parsed.columns else bare


def latest_files(files: DataFrame, *tie_break: str) -> DataFrame:
    """The 20 greatest file names, descending; by name, so kinds are not mixed by time."""
    order = [F.desc("filename")] + [F.desc(name) for name in tie_break]
    return files.orderBy(*order).limit(LATEST_FILES)


def union_feeds(vehicles: DataFrame, trips: DataFrame) -> DataFrame:
    """Rows of both kinds under their feed type; nothing is deduplicated."""
    return vehicles.withColumn("feed_type", F.lit(VEHICLE_POSITIONS)).unionByName(
        trips.withColumn("feed_type", F.lit(TRIP_UPDATES))
    )
