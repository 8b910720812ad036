"""Progress of streaming queries over their whole life, as a table."""

from __future__ import annotations

import json
import threading

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "event string, query_id string, run_id string, batch_id bigint, at string, input_rows bigint, "
    "duration_ms bigint, error string"
)


class ProgressLog(StreamingQueryListener):
    """Writes a small file below ``path`` for every micro-batch, start, end and failure.

    Spark itself remembers the last hundred micro-batches of a running query, on the driver.
    Files are named by run, micro-batch and time, so restarts and several queries share a
    folder.  Triggers that found no data are not written.
    """

    def __init__(self, path: str) -> None:
        self.system, self.base = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        self.system.create_dir(self.base, recursive=True)
        self.ended: dict[str, threading.Event] = {}

    def _write(self, event: str, at: str, **values: object) -> None:
        row = {"event": event, "at": at, **values}
        stamp = at.translate(str.maketrans("", "", "-:."))
        name = f"{event}-{values['run_id']}-{values.get('batch_id', 0):012d}-{stamp}.json"
        with self.system.open_output_stream(f"{self.base}/{name}") as out:
            out.write(json.dumps(row).encode())

    def _end(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event: object) -> None:  # noqa: N802
        self._write("started", event.timestamp, query_id=str(event.id), run_id=str(event.runId))

    def onQueryProgress(self, event: object) -> None:  # noqa: N802
        report = json.loads(event.progress.json)
        if "addBatch" not in report["durationMs"]:
            return
        self._write(
            "batch",
            report["timestamp"],
            query_id=report["id"],
            run_id=report["runId"],
            batch_id=report["batchId"],
            input_rows=sum(source["numInputRows"] for source in report["sources"]),
            duration_ms=report["durationMs"].get("triggerExecution"),
        )

    def onQueryIdle(self, event: object) -> None:  # noqa: N802
        """Nothing has happened."""

    def onQueryTerminated(self, event: object) -> None:  # noqa: N802
        from datetime import UTC, datetime

        at = datetime.now(UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")
        kind = "failed" if event.exception else "ended"
        run_id = str(event.runId)
        self._write(kind, at, query_id=str(event.id), run_id=run_id, error=event.exception)
        self._end(run_id).set()

    def settle(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all that an ended query reported is written; events come a little later."""
        return self._end(str(query.runId)).wait(seconds)


def log_progress(spark: SparkSession, path: str) -> ProgressLog:
    """Record all streaming queries that the session starts from now on, below ``path``."""
    log = ProgressLog(path)
    spark.streams.addListener(log)
    return log


def stop_logging(spark: SparkSession, log: ProgressLog) -> None:
    spark.streams.removeListener(log)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All events below ``path``; times are ISO texts, so they sort as text."""
    return spark.read.schema(PROGRESS).json(path)


def life_totals(spark: SparkSession, path: str) -> DataFrame:
    """One row for each query that has run: everything from its first start to now.

    Columns: query_id, runs, batches, input_rows, last_batch_at, failures, last_error (of the
    latest failure, null where a micro-batch has succeeded since), is_running.
    """
    events = read_progress(spark, path)
    event, at = F.col("event"), F.col("at")
    totals = events.groupBy("query_id").agg(
        F.countDistinct(F.when(event == "started", F.col("run_id"))).alias("runs"),
        F.countDistinct(F.when(event == "batch", F.col("batch_id"))).alias("batches"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
        F.max(F.when(event == "batch", at)).alias("last_batch_at"),
        F.count_if(event == "failed").alias("failures"),
        F.max(F.when(event == "failed", at)).alias("_failed_at"),
        F.max_by("error", F.when(event == "failed", at)).alias("_error"),
        F.count_if(event.isin("failed", "ended")).alias("_ends"),
    )
    mended = F.col("last_batch_at") > F.col("_failed_at")
    return totals.select(
        "query_id",
        "runs",
        "batches",
        "input_rows",
        "last_batch_at",
        "failures",
        F.when(~F.coalesce(mended, F.lit(False)), F.col("_error")).alias("last_error"),
        (F.col("runs") > F.col("_ends")).alias("is_running"),
    )
