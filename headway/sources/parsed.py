"""Parsed snapshots stored as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.schemas import JSON_SNAPSHOT

_WITH_CORRUPT = T.StructType(
    JSON_SNAPSHOT.fields + [T.StructField("_corrupt_record", T.StringType())]
)


def read_parsed(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Snapshots of both kinds plus ``status``: ``ok`` or ``invalid_json``.

    ``one_per_file`` reads indented documents, each a file of its own.  A folder
    written by :func:`headway.sinks.write_parsed` holds one document per line, in a compressed
    file for each writing task; a task reads a file or several.  Plain files of one document
    per line are split among tasks.
    """
    documents = (
        spark.read.schema(_WITH_CORRUPT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("multiLine", str(one_per_file).lower())
        .json(path)
    )
    status = F.when(F.col("_corrupt_record").isNull(), "ok").otherwise("invalid_json")
    return documents.withColumn("status", status)
