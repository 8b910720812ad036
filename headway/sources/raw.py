"""Raw snapshots, as a table or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions import snapshot_epoch, snapshot_kind
from headway.schemas import RAW_FILE


def read_raw(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """``*.pb`` files below a folder: path, modification time, length and bytes."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.pb")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )


def read_raw_stream(
    spark: SparkSession,
    path: str,
    source: str = "binaryFile",
    files_per_trigger: int = 100_000,
    **options: str,
) -> DataFrame:
    """New snapshots as they arrive: ``*.pb`` files, or files of a raw Parquet table.

    ``options`` go to the file source, such as ``cleanSource`` to keep a long-lived
    landing folder short enough to list.
    """
    stream = spark.readStream.schema(RAW_FILE).option("maxFilesPerTrigger", files_per_trigger)
    if source == "binaryFile":
        stream = stream.option("pathGlobFilter", "*.pb")
    return stream.options(**options).format(source).load(path)


def with_names(raw: DataFrame) -> DataFrame:
    """Add ``feed_type`` and ``captured_at`` (epoch seconds), both from the file name."""
    return raw.withColumns(
        {
            "feed_type": snapshot_kind(F.col("path")),
            "captured_at": snapshot_epoch(F.col("path")),
        }
    )
