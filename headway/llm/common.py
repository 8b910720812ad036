"""Helpers shared by the operators: reading, storing, bounded broadcasts, worker state."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import scratch_path

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

# A narrow key table is broadcast up to this many rows (under 50 MB); beyond, it is shuffled.
BROADCAST_ROWS = 250_000

_SAME = "own <=> id and key = of"

Made = TypeVar("Made")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the cluster's shared folder and read back, which cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(keys: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Ask for a broadcast of a stored key table if it is small; else leave the join as it is."""
    return F.broadcast(keys) if keys.count() <= rows else keys


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """Every row whole in a struct ``row``, beside working columns.

    So no working column clashes with one of the rows, whatever those are called.
    """
    return docs.select(F.struct("*").alias("row"), *(value.alias(name) for name, value in more.items()))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def without_ids(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose key is not in the stored one-column table ``dropped``; null keys stay."""
    gone = bounded(dropped.select(F.col(key).alias("gone")))
    kept = packed(docs, own=F.col(key)).join(gone, F.col("own") == F.col("gone"), "left_anti")
    return unpacked(kept)


def without_pairs(docs: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """Rows whose doc_id (null included) and key are not in the stored ``gone``: id, of."""
    keyed = packed(docs, own=F.col("doc_id"), key=key)
    return unpacked(keyed.join(bounded(gone), F.expr(_SAME), "left_anti"))


def without_repeats(docs: DataFrame, repeated: DataFrame, key: Column) -> DataFrame:
    """One row for each doc_id (null included) and key in the stored ``repeated``: id, of."""
    if repeated.isEmpty():
        return docs
    keyed, repeated = packed(docs, own=F.col("doc_id"), key=key), bounded(repeated)
    lone = keyed.join(repeated, F.expr(_SAME), "left_anti")
    # A shuffle of the repeated rows only; each task sends one row of those alike.
    first = keyed.join(repeated, F.expr(_SAME), "left_semi").dropDuplicates(["own", "key"])
    return unpacked(lone.unionByName(first))


def empty_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def give_back() -> None:
    """Return freed memory of this worker to the system, as it lives on for other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def worker_state(name: str, make: Callable[[], Made]) -> Made:
    """An object kept for the life of a Python worker, across tasks."""
    kept = sys.__dict__.setdefault("_headway_llm", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]
