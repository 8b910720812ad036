"""Feed kinds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.lookups import ALERTS, TRIP_UPDATES, VEHICLE_POSITIONS


def feed_type_of(text: Column) -> Column:
    """The kind that a text names in any letter case, or null."""
    kind = F.lower(text)
    return F.when(kind.isin(VEHICLE_POSITIONS, TRIP_UPDATES, ALERTS), kind)


def feed_status(text: Column) -> Column:
    """``ok`` for kinds with a parser, ``unsupported`` for alerts, else ``invalid``."""
    kind = feed_type_of(text)
    return (
        F.when(kind.isNull(), "invalid").when(kind == ALERTS, "unsupported").otherwise("ok")
    )
