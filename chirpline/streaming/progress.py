"""Totals of streaming runs."""

from __future__ import annotations

import threading
import warnings
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from chirpline.schema import BATCH_RANGES
from chirpline.sources.tables import Tables


# What a query may observe of the messages it takes in: how many, and how many of them cannot be decoded.
TAKEN_IN = "taken_in"


class ProgressTotals(StreamingQueryListener):
    """Adds up rows taken in and time spent per run of a query.

    It hears of every batch, whereas a query itself remembers only the last
    hundred. Three numbers are kept per run.
    """

    def __init__(self):
        self._rows: dict[str, int] = defaultdict(int)
        self._milliseconds: dict[str, int] = defaultdict(int)
        self._undecodable: dict[str, int] = defaultdict(int)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self._rows[run] += event.progress.numInputRows
        self._milliseconds[run] += event.progress.batchDuration
        observed = event.progress.observedMetrics.get(TAKEN_IN)
        if observed:
            self._undecodable[run] += observed["undecodable"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def wait(self, queries: Iterable[StreamingQuery], timeout: float = 60.0) -> None:
        """Wait until the end of every run has been reported.

        Events arrive a moment after a query ends. Where one is late, a warning
        says so, and the totals are those of the batches heard of.
        """
        for query in queries:
            if not self._ended[str(query.runId)].wait(timeout):
                warnings.warn(f"no end of query {query.name} reported within {timeout} seconds", stacklevel=2)

    def totals(self, query: StreamingQuery) -> tuple[int, float]:
        """Rows and seconds of a run, complete once it has been waited for."""
        run = str(query.runId)
        return self._rows[run], self._milliseconds[run] / 1000.0

    def undecodable(self, query: StreamingQuery) -> int:
        """Messages of a run that could not be decoded, if it observes them."""
        return self._undecodable[str(query.runId)]


class BatchRanges(StreamingQueryListener):
    """Stores what each batch of a query has taken in, as it is reported.

    One row per batch and source: where the batch began and ended there, and
    how many messages it took in. So a stored batch can be checked against its
    source, or read again (``messages.topic_range``). A batch that is repeated
    after a restart has the same range and stores it anew. Of a batch that was
    finished but not reported before the driver was lost there is no row.
    """

    def __init__(self, spark: SparkSession, store: Tables, name: str):
        self._spark = spark
        self._store = store
        self._name = name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self._name or not progress.numInputRows:
            return
        rows = [
            (progress.name, progress.batchId, x.description, x.startOffset, x.endOffset, x.numInputRows)
            for x in progress.sources
        ]
        self._store.write_batch(self._spark.createDataFrame(rows, BATCH_RANGES), "batch_ranges", progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
