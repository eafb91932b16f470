"""Run metrics: one row per run, batch or streaming."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from chirpline.schema import METRIC
from chirpline.sources.tables import Tables
from chirpline.streaming.progress import ProgressTotals

T = TypeVar("T")


def timed(work: Callable[[], T]) -> tuple[T, float]:
    """Result of a call and the seconds it took."""
    start = time.perf_counter()
    result = work()
    return result, time.perf_counter() - start


def record_run(spark: SparkSession, store: Tables, processing_type: str, records: int, seconds: float) -> None:
    """Add one row to the metric table."""
    row = spark.createDataFrame([(processing_type, records, seconds)], METRIC)
    store.append(row, "performance_metrics")


def record_stream(spark: SparkSession, store: Tables, progress: ProgressTotals, query: StreamingQuery) -> None:
    """Add the row of a streaming run that has ended, and one for messages it could not decode, if there were any."""
    records, seconds = progress.totals(query)
    record_run(spark, store, "streaming", records, seconds)
    if bad := progress.undecodable(query):
        record_run(spark, store, "streaming_undecodable", bad, seconds)
