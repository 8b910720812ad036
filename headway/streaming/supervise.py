"""Ingestion that goes on after a failed micro-batch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

from headway.lookups import FIRST_WAIT_SECONDS, MAX_ATTEMPTS


def supervise(
    start: Callable[[], StreamingQuery],
    attempts: int | None = MAX_ATTEMPTS,
    wait: float = FIRST_WAIT_SECONDS,
    longest: float = 300,
    pause: Callable[[float], None] = time.sleep,
) -> StreamingQuery:
    """Start a query, and start it again whenever it fails; returns once it ends by itself.

    ``start`` starts it from its checkpoint, so what had been committed is not repeated and
    what had not is taken up again.  The wait doubles with each failure in a row, up to
    ``longest`` seconds.  A run that completed a micro-batch begins a new row; after
    ``attempts`` failures in a row, the last one is raised, and with None never.  Failures
    are in the progress log (:mod:`headway.streaming.progress`).
    """
    failures = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            progress = query.lastProgress
            failures = 1 if progress and progress.numInputRows else failures + 1
            if attempts is not None and failures >= attempts:
                raise
        pause(min(longest, wait * 2 ** (failures - 1)))
