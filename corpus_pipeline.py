"""From raw documents to encoded training text, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import exact_dedup, langid, mixing, near_dedup, pieces
from headway.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; the rest go."""
    return langid.confident(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near-duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight takes it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, best ids and alternatives of every text, with whether the ids decode to it."""
    return pieces.encode(docs, pieces.load()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        "score",
        "alternatives",
        "round_trip",
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("mix", mix),
    ("encode", encode),
]

# The stages fit, search and iterate, which SQL does not express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
