"""Parquet and JSON outputs in daily folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from headway.functions import day_folder

DAY = ("year", "month", "day")

# JSON repeats its keys in every record, so it takes a tenth of its bytes once compressed.
# Spark's readers know the form by the file's name.
CODECS = {"json": "gzip", "parquet": "zstd"}


def with_day(df: DataFrame, seconds: Column) -> DataFrame:
    """Add ``year``, ``month`` and ``day`` of a record's own UTC second."""
    return df.withColumns(day_folder(seconds))


def write_daily(
    df: DataFrame,
    path: str,
    mode: str = "append",
    rebalance: bool = True,
    below: tuple[str, ...] = (),
    source: str = "parquet",
    **options: str,
) -> None:
    """Write Parquet, or JSON with explicit nulls, below ``year=/month=/day=``; ``df`` has those columns.

    With ``rebalance`` adaptive execution gives each day as many tasks as its size asks
    for: a hot day is split and small days are joined, so neither one huge nor
    thousands of tiny files come out.  Input already in time order can do without it.
    Columns named in ``below`` become folders below the day; ``options`` go to the writer.
    Files are compressed, JSON by gzip and Parquet by zstd, unless ``compression`` says otherwise.
    """
    shaped = df.hint("rebalance", *DAY) if rebalance else df
    writer = shaped.write.mode(mode).options(**options).partitionBy(*DAY, *below)
    if source in CODECS and "compression" not in options:
        writer = writer.option("compression", CODECS[source])
    writer.option("ignoreNullFields", "false").format(source).save(path)


def write_parsed(parsed: DataFrame, path: str, mode: str = "append") -> None:
    """Write parsed snapshots as JSON, one document per line, with explicit nulls, by gzip."""
    parsed.write.mode(mode).option("ignoreNullFields", "false").json(path, compression=CODECS["json"])
