"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    chat,
    exact_dedup,
    fingerprints,
    langid,
    mixing,
    near_dedup,
    pieces,
    prefix_trie,
    privacy,
    quality,
    repair,
    token_counts,
    url_filter,
)
from headway.llm.common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best ids, alternatives, and whether the ids decode to the text."""
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.load()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        "score",
        "alternatives",
        "round_trip",
    )


def op2_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.personal_data(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after three edits of every document."""
    ranks = token_counts.load()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = token_counts.with_trees(docs, ranks).withColumn("edits", token_counts.trial_edits())
    return token_counts.edited(state, ranks).select(
        "doc_id", "n_before", "n_tokens", "n_pretokens", "n_reencoded", F.sha2("text", 256).alias("text_sha256")
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    return url_filter.judged(table(spark, sf_dir, "pages"), rules)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_planted(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.formatted(chat.linear(rows)))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damage_and_repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_sentencepiece,
        op2_privacy,
        op3_mixing,
        op4_token_counts,
        op5_url_filter,
        op6_chat,
        op7_exact_dedup,
        op8_quality,
        op9_near_dedup,
        op10_langid,
        op11_fingerprints,
        op12_prefix_trie,
        op13_repair,
    )
}

# The others are searches, fits and iterations that SQL does not express.
ORACLE: dict[str, str] = {
    "op5_url_filter": url_filter.ORACLE,
    "op6_chat": chat.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
