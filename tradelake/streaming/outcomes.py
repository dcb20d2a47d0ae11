"""What became of every micro-batch, as Spark reports it.

A batch counts as written once Spark has committed its offsets, which a query listener
hears of; it failed if the sink raised or if the query ended with an error. Outcomes are
small JSON files named by query, batch and attempt, so a repeated report replaces itself
and a restarted driver goes on counting attempts where the last one stopped.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tradelake.sources.files import Files

OUTCOMES = (
    "node_id bigint, query string, batch bigint, attempt bigint, at_ms bigint, outcome string, "
    "n bigint, error string"
)
#: Reports of so many batches share a folder, so listing one stays cheap.
FOLDER = 1_000
ATTEMPTS = 1 << 16


class FlushLog(StreamingQueryListener):
    """Outcomes of the micro-batches of a node's ingest queries, kept in ``path``."""

    def __init__(self, spark: SparkSession, path: str, node_id: int):
        super().__init__()
        self.spark, self.path, self.node_id = spark, path, node_id
        self._stored: dict[tuple[str, int], int] = {}
        self._blamed: set[str] = set()
        self._ended: dict[str, tuple[str, str | None]] = {}
        self._followed: set[str] = set()
        self._change = threading.Condition()
        spark.streams.addListener(self)

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    # What the sink tells

    def attempts(self, query: str, batch: int) -> int:
        """How often a batch has been reported so far."""
        folder = self._folder(query, batch)
        return sum(n.startswith(f"{batch}-") for n in Files(self.spark, self.path).children(folder))

    def stored(self, query: str, batch: int, n: int) -> None:
        """The sink holds the batch; it counts once Spark commits it."""
        self._stored[query, batch] = n

    def failed(self, query: str, batch: int, run: str | None, n: int, error: str, final: bool = False) -> None:
        if run is not None:
            self._blamed.add(run)
        outcome = "final_failure" if final else "failure"
        self._report(query, batch, outcome, n, error, int(time.time() * 1000))

    # What Spark tells

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress
        query, batch = str(told.id), told.batchId
        n = self._stored.pop((query, batch), None)
        if n is None:
            return
        began = dt.datetime.fromisoformat(told.timestamp.replace("Z", "+00:00"))
        at_ms = int(began.timestamp() * 1000) + told.batchDuration
        again = self.attempts(query, batch) > 0
        self._report(query, batch, "retry_success" if again else "success", n, None, at_ms)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended[str(event.runId)] = (str(event.id), event.exception)
            self._change.notify_all()
        self._look_back()

    def follow(self, query: StreamingQuery) -> None:
        """Report this query's end too, if the sink has not been asked by then."""
        with self._change:
            self._followed.add(str(query.runId))
        self._look_back()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until everything of a query that has ended is reported."""
        run, until = str(query.runId), time.monotonic() + seconds
        with self._change:
            while run not in self._ended:
                if not self._change.wait(until - time.monotonic()):
                    raise TimeoutError("Spark has not reported the end of the query")

    def _look_back(self) -> None:
        """Queries that ended with an error before or after the sink's own work."""
        with self._change:
            due = [run for run in self._followed if run in self._ended]
            self._followed -= set(due)
        for run in due:
            query, error = self._ended[run]
            if error is not None and run not in self._blamed:
                last = outcomes(self.spark, self.path).filter(
                    (F.col("query") == query) & (F.col("outcome") != "failure")
                )
                batch = last.agg(F.max("batch")).first()[0]
                self.failed(query, 0 if batch is None else batch + 1, run, 0, error)

    # The files

    def _folder(self, query: str, batch: int) -> str:
        return f"{self.path}/{query}/{batch // FOLDER}"

    def _report(self, query: str, batch: int, outcome: str, n: int, error: str | None, at_ms: int) -> None:
        attempt = self.attempts(query, batch)
        row = {
            "node_id": self.node_id, "query": query, "batch": batch, "attempt": attempt,
            "at_ms": at_ms, "outcome": outcome, "n": n, "error": error,
        }
        name = f"{self._folder(query, batch)}/{batch}-{attempt}.json"
        Files(self.spark, self.path).write_text(name, json.dumps(row))


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """The reported outcomes: see ``OUTCOMES``. Their order is (query, batch, attempt)."""
    if not Files(spark, path).children(path):
        return spark.createDataFrame([], OUTCOMES)
    return spark.read.schema(OUTCOMES).json(f"{path}/*/*")


def write_attempts(spark: SparkSession, path: str) -> DataFrame:
    """The outcomes as write attempts of their nodes, for
    :func:`tradelake.operators.pipeline.flush_outcome_events`."""
    place = F.col("batch") * ATTEMPTS + F.col("attempt")
    return outcomes(spark, path).select(
        place.alias("seq"), "node_id", "at_ms", "outcome", F.coalesce("n", F.lit(0)).alias("n"), "error"
    )


def supervise(
    start: Callable[[], StreamingQuery], restarts: int, pause_s: float = 1.0, log: FlushLog | None = None
) -> StreamingQuery:
    """Run a query until it ends by itself; after an error start it again.

    A new run goes on from the checkpoint, so the failed batch comes first and holds
    the same rows. After ``restarts`` of them the error is raised.
    """
    for left in range(restarts, -1, -1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if not left:
                raise
            time.sleep(pause_s)
        finally:
            if log is not None:
                log.wait(query)
    raise AssertionError("not reached")
