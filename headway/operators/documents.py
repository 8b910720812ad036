"""Interpretation of stored documents as they are: typed columns beside the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.lookups import FIRST_VEHICLES
from headway.operators.vehicles import interpret_vehicles
from headway.sources.documents import field


def _has_vehicles(document: Column) -> Column:
    return F.try_variant_get(document, "$.vehicles", "variant").isNotNull()


def invalid_documents(documents: DataFrame) -> DataFrame:
    """Documents that are no JSON, with their text; nothing else takes them up."""
    return documents.where("status <> 'ok'").drop("document")


def passed_documents(documents: DataFrame) -> DataFrame:
    """Documents without vehicles, which interpretation returns untouched."""
    return documents.where((F.col("status") == "ok") & ~_has_vehicles(F.col("document")))


def interpret_documents(documents: DataFrame, *keys: str) -> DataFrame:
    """The first 50 vehicles of each document with vehicles, interpreted, next to the full count.

    Columns: ``keys``, ``header`` (VARIANT, an empty object where it is absent),
    ``total_vehicles``, ``entity_pos``, ``vehicle`` (VARIANT, with every key it was stored
    with), id, trip_id, route_id and timestamp, and what interpretation adds.  A document with
    an empty list keeps one row with a total of 0 and null elsewhere.  Vehicles that are no
    list count as an empty one.  The cut comes first, so nothing beyond it is interpreted.
    """
    document = F.col("document")
    listed = F.coalesce(
        F.try_variant_get(document, "$.vehicles", "array<variant>"), F.expr("cast(array() as array<variant>)")
    )
    header = F.coalesce(F.try_variant_get(document, "$.header", "variant"), F.parse_json(F.lit("{}")))
    held = documents.where((F.col("status") == "ok") & _has_vehicles(document)).select(
        *keys, header.alias("header"), listed.alias("_vehicles")
    )
    first = held.select(
        *keys,
        "header",
        F.size("_vehicles").cast("bigint").alias("total_vehicles"),
        F.posexplode_outer(F.slice("_vehicles", 1, FIRST_VEHICLES)).alias("entity_pos", "vehicle"),
    )
    typed = {"id": "string", "trip_id": "string", "route_id": "string", "timestamp": "bigint"}
    vehicle = F.col("vehicle")
    columns = {name: field(vehicle, f"$.{name}", kind) for name, kind in typed.items()}
    return interpret_vehicles(first.withColumns(columns))


def interpreted_vehicle(interpreted: DataFrame) -> Column:
    """A vehicle as a JSON text with every stored key and those that interpretation added.

    An absent addition is no key, as in the stored form.
    """
    added = F.to_json(F.struct("route_name", "trip_info", "timestamp_readable"))
    stored = F.to_json("vehicle")
    joined = F.concat(
        F.substr(stored, F.lit(1), F.length(stored) - 1),
        F.when((stored != "{}") & (added != "{}"), ",").otherwise(""),
        F.substr(added, F.lit(2)),
    )
    return F.when(F.col("vehicle").isNotNull(), joined)
