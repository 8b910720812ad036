"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Snapshots are whole messages in one binary column, so the byte bound is
    # what keeps an Arrow batch small; the row bound alone would not.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # The JVM never compiles a method above 8000 bytes; a wide projection that would
    # become one is run as several smaller methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the package's settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``.  Only a local master may go
    without it, and then uses the context's checkpoint folder or else its warehouse.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/headway/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, which cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
