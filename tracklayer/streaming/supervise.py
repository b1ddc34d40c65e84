"""Supervision of streaming queries: progress noted by a listener, and a bounded number of new starts after failures.

A query that fails is started again from its checkpoint, which runs the failed micro-batch anew; the jobs of this package
take such a replay as the same batch. After `restarts` failures without a finished micro-batch in between the last
failure surfaces. What is noted can be had as a table.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: One row for each finished micro-batch, start and failure.
NOTES = "run string, kind string, batch long, rows long, observed string, error string"
#: Notes kept in the driver; older ones are dropped, counts go on.
KEPT_NOTES = 10_000


@dataclass
class Notes(StreamingQueryListener):
    """What a supervised query did, in order."""

    rows: deque = field(default_factory=lambda: deque(maxlen=KEPT_NOTES))
    batches: int = 0
    failures: int = 0
    ended: set = field(default_factory=set)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.rows.append((str(event.runId), "start", None, None, None, None))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        observed = {name: row.asDict() for name, row in p.observedMetrics.items()}
        self.batches += 1
        self.rows.append((str(p.runId), "batch", p.batchId, p.numInputRows, json.dumps(observed, sort_keys=True), None))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self.failures += 1
            self.rows.append((str(event.runId), "failure", None, None, None, str(event.exception).splitlines()[0]))
        self.ended.add(str(event.runId))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), NOTES)


def run_supervised(
    spark: SparkSession, start: Callable[[], StreamingQuery], *, restarts: int = 3, wait_seconds: float = 10.0, settle_seconds: float = 30.0
) -> Notes:
    """Run a query that ends by itself (or by failing for good) and note what it does.

    `start` begins the query from its checkpoint. The wait before a new start doubles with each failure in a row.
    """
    notes, in_a_row = Notes(), 0
    spark.streams.addListener(notes)
    try:
        while True:
            before = notes.batches
            query = start()
            try:
                query.awaitTermination()
                return notes
            except StreamingQueryException:
                in_a_row = 1 if _settled(notes, query, settle_seconds) > before else in_a_row + 1
                if in_a_row > restarts:
                    raise
                time.sleep(wait_seconds * 2 ** (in_a_row - 1))
            finally:
                _settled(notes, query, settle_seconds)
    finally:
        spark.streams.removeListener(notes)


def _settled(notes: Notes, query: StreamingQuery, seconds: float) -> int:
    """Batches noted once the query's last event has come, for which listeners wait in a queue."""
    until = time.monotonic() + seconds
    while str(query.runId) not in notes.ended and time.monotonic() < until:
        time.sleep(0.05)
    return notes.batches
