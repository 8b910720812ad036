"""Display names for routes, directions and stops."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.lookups import DIRECTION_NAMES, ROUTE_NAMES


def _literal_map(names: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(text) for pair in names.items() for text in pair])


def route_name(route_id: Column) -> Column:
    """Display name; an unknown id falls back to ``Route <id>``, null stays null."""
    return F.coalesce(_literal_map(ROUTE_NAMES)[route_id], F.concat(F.lit("Route "), route_id))


def direction_name(code: Column) -> Column:
    """Direction word; an unknown letter is its own name, empty gives null."""
    return F.when(code != "", F.coalesce(_literal_map(DIRECTION_NAMES)[code], code))


def stop_name(stop_id: Column, known_name: Column | None = None) -> Column:
    """The known name when there is one, else ``Stop <id>``."""
    fallback = F.concat(F.lit("Stop "), stop_id)
    return fallback if known_name is None else F.coalesce(known_name, fallback)
