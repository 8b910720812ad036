"""Route and stop dimensions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from headway.lookups import ROUTE_NAMES


def routes(spark: SparkSession) -> DataFrame:
    """The known routes: ``route_id``, ``route_name``; a literal relation in the plan."""
    ids, names = zip(*ROUTE_NAMES.items())
    return spark.createDataFrame(pa.table({"route_id": ids, "route_name": names}))


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    """``stop_id``, ``stop_name`` from the ``stops.txt`` of a static feed."""
    stops = spark.read.option("header", True).csv(path)
    return stops.select("stop_id", "stop_name")
