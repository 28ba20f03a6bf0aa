"""Stored progress of every streaming query of a session."""

from __future__ import annotations

from threading import Event, Lock

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from gradeflow.streaming.batches import MESSAGES, BatchMetrics, write_metrics


class ProgressStore(StreamingQueryListener):
    """Writes each batch's progress under ``root``, by query id and batch, as batch jobs do.

    Whatever the sink, so plain append streams have metrics too; ``batches.read_metrics``
    reads them. Rejected and damaged messages come from counts that the stream observes
    (``batches.start_append`` does). A batch that runs again, before or after a restart,
    replaces its own row; triggers without input leave none. Rows written are -1 where the sink does not
    report them. Use a root that no batch job stores its metrics in.

    Progress arrives some time after its batch: :meth:`settled` waits until all of a query
    is stored. ``with ProgressStore(spark, root) as store`` adds and removes the listener.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.ended: dict[str, Event] = {}
        self.failures: list[Exception] = []
        self.lock = Lock()

    def __enter__(self) -> ProgressStore:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def _end_of(self, run: str) -> Event:
        with self.lock:
            return self.ended.setdefault(run, Event())

    def settled(self, query: StreamingQuery, timeout: float = 300) -> None:
        """Wait for the end of a query and of its progress; raise what either raised."""
        query.awaitTermination()
        if not self._end_of(str(query.runId)).wait(timeout):
            raise TimeoutError(f"no word of the end of query {query.id} within {timeout} seconds")
        if self.failures:
            raise self.failures[0]

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress
        if not found.numInputRows:
            return
        seen = found.observedMetrics.get(MESSAGES)
        metrics = BatchMetrics(
            found.batchId,
            found.numInputRows if seen is None else seen["rows"],
            found.sink.numOutputRows,
            found.durationMs.get("triggerExecution", 0) / 1000.0,
            0 if seen is None else seen["rejected"],
            0 if seen is None else seen["damaged"],
        )
        try:
            write_metrics(self.spark, self.root, str(found.id), metrics)
        except Exception as error:  # the listener's thread would swallow it
            self.failures.append(error)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end_of(str(event.runId)).set()
