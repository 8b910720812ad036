"""State of a running or finished query as rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions.times import iso_time
from headway.streaming.ingest import read_ingested

STATUS = (
    "batch_id bigint, started_at string, input_rows bigint, duration_ms bigint, "
    "is_running boolean, trigger string, sources string, sink string, last_error string"
)


def setting_of(trigger: dict | None) -> str | None:
    """A trigger as text."""
    return ", ".join(f"{name}={value}" for name, value in (trigger or {}).items()) or None


def status_totals(query: StreamingQuery, target: str, trigger: dict | None = None) -> DataFrame:
    """Per feed kind: snapshots taken in and quarantined by all batches, and the live state.

    ``last_fetch_time`` is when the latest snapshot was captured that could be decoded.  The counts come from the tables below ``target``, so they cover the whole life of an
    ingestion and not only the micro-batches that Spark still remembers.
    """
    spark = SparkSession.active()
    problem = query.exception()
    totals = read_ingested(spark, target, "snapshots").groupBy("feed_type").agg(
        F.count("*").alias("snapshots"),
        F.count("decode_error").alias("quarantined"),
        iso_time(F.max(F.when(F.col("decode_error").isNull(), F.col("captured_at")))).alias("last_fetch_time"),
    )
    return totals.withColumns(
        {
            "is_running": F.lit(query.isActive),
            "trigger": F.lit(setting_of(trigger)).cast("string"),
            "last_error": F.lit(str(problem) if problem else None).cast("string"),
        }
    )


def status_frame(query: StreamingQuery, trigger: dict | None = None) -> DataFrame:
    """The live view: one row per recent micro-batch; ``trigger`` is what the query was started with.

    Spark keeps a bounded number of these on the driver
    (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    problem = query.exception()
    setting = setting_of(trigger)
    rows = []
    for progress in query.recentProgress:
        report = json.loads(progress.json)
        rows.append(
            (
                report["batchId"],
                report["timestamp"],
                sum(source["numInputRows"] for source in report["sources"]),
                report["durationMs"].get("triggerExecution"),
                query.isActive,
                setting,
                ", ".join(source["description"] for source in report["sources"]),
                report["sink"]["description"],
                str(problem) if problem else None,
            )
        )
    return SparkSession.active().createDataFrame(rows, STATUS)
