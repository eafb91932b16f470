"""The streaming job, and the current counts it has stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chirpline.plans.metrics import record_stream
from chirpline.sources import tables
from chirpline.sources.tables import Tables
from chirpline.streaming.progress import BatchRanges, ProgressTotals
from chirpline.streaming.queries import finish, start_all, start_shared, wait_any
from chirpline.streaming.running import Output


def current_counts(store: Tables, output: Output, stored_as: str = "current") -> DataFrame:
    """Running counts of an output as last stored, whichever way they are stored."""
    return tables.current_counts(store, output.table, stored_as)


def run_live(
    spark: SparkSession,
    messages: DataFrame,
    store: Tables,
    checkpoint: str,
    *,
    shared: bool = False,
    **options,
) -> None:
    """Start the outputs and run until one query ends, then stop the rest.

    With ``interval=None`` every query works off what is there instead. A
    metric row is written for the query that stores the raw tweets, which takes
    in every message once; a run that fails has none. What each batch of that
    query took in is stored as well.
    """
    progress = ProgressTotals()
    ranges = BatchRanges(spark, store, "all_outputs" if shared else "tweets")
    # The ranges are written before the totals hear of the same event.
    spark.streams.addListener(ranges)
    spark.streams.addListener(progress)
    spark.streams.resetTerminated()
    try:
        if shared:
            queries = [start_shared(messages, store, checkpoint, **options)]
        else:
            queries = start_all(messages, store, checkpoint, **options)
        names = [query.name for query in queries]
        raw = queries[names.index("all_outputs" if shared else "tweets")]
        if options.get("interval", "") is None:
            finish(queries)
        else:
            wait_any(spark, queries)
        store.settle()
        progress.wait(queries)
        record_stream(spark, store, progress, raw)
    finally:
        spark.streams.removeListener(progress)
        spark.streams.removeListener(ranges)
