"""Stored JSON documents without a schema: every key a document has is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Stored documents: path, ``status``, ``document`` (VARIANT) and ``invalid`` (their text).

    A document that is no JSON has status ``invalid_json``, its text in ``invalid`` and no
    ``document``; any other is kept whole, whatever its keys.  ``one_per_file`` reads indented
    documents, each a file of its own and one value in memory; otherwise each line is a
    document, files are split among tasks unless compressed and blank lines are passed over.  Spark's file
    sources pass over files of length 0.
    """
    text = spark.read.text(path, wholetext=one_per_file)
    rows = text.select(F.col("_metadata.file_path").alias("path"), "value")
    if not one_per_file:
        rows = rows.where(F.trim("value") != "")
    parsed = rows.withColumn("document", F.try_parse_json("value"))
    bad = F.col("document").isNull()
    return parsed.select(
        "path",
        F.when(bad, "invalid_json").otherwise("ok").alias("status"),
        "document",
        F.when(bad, F.col("value")).alias("invalid"),
    )


def field(document: Column, path: str, kind: str) -> Column:
    """A value of a document as ``kind``; null where it is absent or something else."""
    return F.try_variant_get(document, path, kind)
