"""What is done with each micro-batch.

A failing write raises, so the batch is not marked done and is tried again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from chirpline.operators.ordering import by_count
from chirpline.schema import ENDINGS
from chirpline.sources.messages import undecodable
from chirpline.sources.tables import Tables
from chirpline.streaming.running import AIRLINE, HASHTAGS, RAW

BatchWriter = Callable[[DataFrame, int], None]

INCREMENTS = ENDINGS["increments"]


def unless_empty(write: BatchWriter) -> BatchWriter:
    """Skip empty batches. The batch is kept while it is looked at and written,
    so its input is read once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                write(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def replace_table(store: Tables, table: str) -> BatchWriter:
    """The table always holds the latest counts, and only those."""
    return unless_empty(lambda batch, batch_id: store.replace(batch, table))


def add_batch(store: Tables, table: str) -> BatchWriter:
    """The table gains the rows of the batch, once."""
    return unless_empty(lambda batch, batch_id: store.write_batch(batch, table, batch_id))


def add_rows(store: Tables, table: str) -> BatchWriter:
    """The same, for rows that come straight from the source.

    Keeping those rows to look at them first would cost as much as writing
    them, and reading them twice would count them twice. Such a batch is empty
    only if the source has moved on without a message; it then adds no rows.
    """
    return lambda batch, batch_id: store.write_batches({table: batch}, batch_id)


def show_batch(rows: int) -> BatchWriter:
    """Print the ``rows`` largest counts of each batch, and say if there are more.

    Spark's own console sink brings the whole batch to the driver before it
    prints a few rows; this brings only those. Finding the largest reads every
    state partition to its end, as a batch must for its state to be kept: a
    plain ``show`` would stop at the first partitions that have enough rows.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        by_count(batch).show(rows, truncate=False)

    return run


def all_outputs(store: Tables) -> BatchWriter:
    """Raw tweets and the counts of a batch, from one reading of it.

    The counts cover the batch alone and are stored as increments; adding them
    up gives the running counts. No state is kept between batches, so nothing
    grows with the number of hashtags ever seen. Counts by sentiment are sums
    of those by airline and sentiment, so they are not stored. Messages that
    cannot be decoded are counted like any other, under null, and set aside.
    """

    def write(records: DataFrame, batch_id: int) -> None:
        bad = undecodable(records)
        parts = {
            RAW.table: RAW.make(records),
            HASHTAGS.table + INCREMENTS: HASHTAGS.make(records),
            AIRLINE.table + INCREMENTS: AIRLINE.make(records),
        }
        if not bad.isEmpty():
            parts["undecodable"] = bad
        store.write_batches(parts, batch_id)

    return unless_empty(write)
