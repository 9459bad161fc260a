"""What a running stream tells: its first rows, and how many it has received."""

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryProgress,
)


class _Listener(StreamingQueryListener):
    def onQueryStarted(self, event: QueryStartedEvent) -> None: ...

    def onQueryProgress(self, event: QueryProgressEvent) -> None: ...

    def onQueryIdle(self, event: QueryIdleEvent) -> None: ...

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None: ...


class _FirstRows(_Listener):
    """Hears of the first batch of a query that has rows, or of its end."""

    def __init__(self, query: StreamingQuery):
        self.run = str(query.runId)
        self.told = threading.Event()
        self.progress: StreamingQueryProgress | None = None

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        if str(progress.runId) == self.run and progress.numInputRows and not self.told.is_set():
            self.progress = progress
            self.told.set()

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        if str(event.runId) == self.run:
            self.told.set()


def _so_far(query: StreamingQuery) -> StreamingQueryProgress | None:
    return next((p for p in query.recentProgress if p.numInputRows), None)


def wait_for_rows(
    spark: SparkSession, query: StreamingQuery, timeout_s: float
) -> StreamingQueryProgress:
    """Waits until a batch of the query that took in rows is done, and returns its progress.

    A batch that was done before counts too. TimeoutError after ``timeout_s`` seconds; an error of
    the query is raised; EOFError if it ended without rows. The query goes on in all cases.
    """
    listener = _FirstRows(query)
    spark.streams.addListener(listener)
    try:
        found = _so_far(query)
        if found is None and query.isActive:
            if not listener.told.wait(timeout_s):
                raise TimeoutError(
                    f"query {query.name or query.id} had no rows within {timeout_s} s"
                )
            found = listener.progress
        found = found or _so_far(query)
    finally:
        spark.streams.removeListener(listener)
    if found is not None:
        return found
    error = query.exception()
    raise error if error is not None else EOFError(f"query {query.name or query.id} had no rows")


class RunningCount(_Listener):
    """Rows that the queries of a session have taken in while this listens.

    For a display; it hears of a batch a little after it is done, and nothing of what was before.
    ``received_so_far`` has the durable count of ``append_folders``.
    """

    def __init__(self, spark: SparkSession):
        self._streams = spark.streams
        self._counts: dict[str, tuple[int, int]] = {}
        self._changed = threading.Condition()
        self._streams.addListener(self)

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        with self._changed:
            last, total = self._counts.get(str(progress.id), (-1, 0))
            if progress.batchId > last:
                self._counts[str(progress.id)] = progress.batchId, total + progress.numInputRows
            self._changed.notify_all()

    def received(self, query: StreamingQuery) -> int:
        """Rows of a query heard of so far, over its restarts too."""
        with self._changed:
            return self._counts.get(str(query.id), (-1, 0))[1]

    def wait_for(self, query: StreamingQuery, rows: int, timeout_s: float) -> bool:
        """Waits until the query has received so many rows; False if it has not by then."""

        def enough() -> bool:
            return self._counts.get(str(query.id), (-1, 0))[1] >= rows

        with self._changed:
            return self._changed.wait_for(enough, timeout_s)

    def close(self) -> None:
        self._streams.removeListener(self)
