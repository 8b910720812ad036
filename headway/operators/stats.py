"""Statistics over attempt, upload and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.times import iso_time


def fetch_stats(attempts: DataFrame, *keys: str) -> DataFrame:
    """Fetch counters from a log with one row per attempt.

    Input: ``keys``, ``attempt_key`` (BIGINT, increasing over attempts, none twice for the
    same keys), ``ok``, ``exhausted`` (a failed last attempt), ``fetched_at`` (epoch seconds,
    with a fraction if there is one), ``error``.  Totals count attempts while failures count
    exhausted fetches, so they need not add up.  ``last_error`` belongs to the latest attempt
    and is null if that one succeeded.

    Only numbers are aggregated, so nothing is sorted; the text of the latest error is looked
    up in the log afterwards, by the few keys that the counters have.
    """
    ok = F.col("ok")
    counted = attempts.groupBy(*keys).agg(
        F.count("*").alias("total_fetches"),
        F.count_if(ok).alias("successful_fetches"),
        F.count_if("exhausted").alias("failed_fetches"),
        F.max(F.when(ok, F.col("fetched_at"))).alias("_fetched"),
        F.max("attempt_key").alias("_latest"),
    )
    latest = counted.select(*(F.col(key).alias(f"_of_{key}") for key in keys), F.col("_latest").alias("_at"))
    same = F.col("attempt_key") == F.col("_at")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    # Without keys there is one row of counters.
    errors = attempts.where(~ok).join(latest if keys else F.broadcast(latest), same)
    found = errors.select(*latest.columns, F.col("error").alias("last_error"))
    own = F.col("_latest") == F.col("_at")
    for key in keys:
        own &= F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return counted.join(found, own, "left").select(
        *keys,
        "total_fetches",
        "successful_fetches",
        "failed_fetches",
        iso_time(F.col("_fetched")).alias("last_fetch_time"),
        "last_error",
    )


def upload_stats(uploads: DataFrame, *keys: str) -> DataFrame:
    """Upload counters from a log with ``outcome`` ``ok``, ``failed`` or ``skipped``.

    A skipped upload (no target, or no such file) is not counted at all.
    """
    outcome = F.col("outcome")
    return uploads.groupBy(*keys).agg(
        F.count_if(outcome.isin("ok", "failed")).alias("total_uploads"),
        F.count_if(outcome == "ok").alias("successful_uploads"),
        F.count_if(outcome == "failed").alias("failed_uploads"),
    )


def flow_summary(runs: DataFrame, run: str) -> DataFrame:
    """One row per run from a log with one row per feed: ``ok`` and ``finished_at``.

    A run with any failed feed failed as a whole and reports no counts.
    """
    every = F.bool_and("ok")
    return runs.groupBy(run).agg(
        F.when(every, "completed").otherwise("failed").alias("flow_status"),
        F.when(every, F.count_if("ok")).alias("success_count"),
        F.when(every, F.count("*")).alias("total_count"),
        iso_time(F.max("finished_at")).alias("completed_at"),
    )
