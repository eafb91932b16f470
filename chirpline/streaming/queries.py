"""Starting, running and stopping the streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chirpline.operators.records import tweet_cards
from chirpline.schema import ENDINGS
from chirpline.session import LARGE_STATE, settings
from chirpline.sources.messages import BAD, decode, judge
from chirpline.sources.tables import Tables
from chirpline.streaming.progress import TAKEN_IN
from chirpline.streaming.running import HASHTAGS, RAW, RUNNING_COUNTS, Output
from chirpline.streaming.sinks import (
    BatchWriter,
    add_batch,
    add_rows,
    all_outputs,
    replace_table,
    show_batch,
)

# How often the tables and the console are brought up to date.
TABLE_INTERVAL = "30 seconds"
CONSOLE_INTERVAL = "10 seconds"

# Shuffle partitions of a count with few keys. They hold a handful of rows at
# any input size, as tasks count before the shuffle.
FEW_KEYS_PARTITIONS = 4

# How a running count is stored -> output mode, writer.
STORED_AS: dict[str, tuple[str, Callable[..., BatchWriter]]] = {
    "current": ("complete", replace_table),
    "history": ("complete", add_batch),
    "changes": ("update", add_batch),
}


def _trigger(interval: str | None) -> dict:
    """``None`` works off what is there, in bounded batches, and ends."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def state_settings(spark: SparkSession, output: Output, partitions: int | None = None) -> dict[str, str]:
    """Shuffle and state options of a running count.

    The number of partitions stays with a checkpoint for good. A count with
    unbounded keys takes one per core the session has at that time, so set
    ``partitions`` where the cluster is still to grow.
    """
    if not output.large:
        return {"spark.sql.shuffle.partitions": str(partitions or FEW_KEYS_PARTITIONS)}
    cores = max(spark.sparkContext.defaultParallelism, FEW_KEYS_PARTITIONS)
    return {"spark.sql.shuffle.partitions": str(partitions or cores), **LARGE_STATE}


def _start(
    rows: DataFrame, writer: BatchWriter, *, mode: str, name: str, checkpoint: str, interval: str | None
) -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(writer)
        .queryName(name)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
        .trigger(**_trigger(interval))
        .start()
    )


def start_count(
    messages: DataFrame,
    output: Output,
    store: Tables,
    checkpoint: str,
    *,
    stored_as: str = "current",
    interval: str | None = TABLE_INTERVAL,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep one running count in the store.

    ``current`` replaces the table each batch. ``history`` keeps every
    snapshot. ``changes`` writes only the keys that a batch has touched, which
    is what to use once a full snapshot of the hashtags is too much to write.
    """
    mode, writer = STORED_AS[stored_as]
    table = output.table + ENDINGS[stored_as]
    spark = messages.sparkSession
    counted = output.make(decode(messages, output.fields))
    with settings(spark, state_settings(spark, output, state_partitions)):
        return _start(counted, writer(store, table), mode=mode, name=table, checkpoint=checkpoint, interval=interval)


def start_tweets(
    messages: DataFrame, store: Tables, checkpoint: str, *, interval: str | None = TABLE_INTERVAL
) -> StreamingQuery:
    """Store the key fields of every tweet."""
    rows = RAW.make(decode(messages, RAW.fields))
    return _start(
        rows, add_rows(store, RAW.table), mode="append", name=RAW.table, checkpoint=checkpoint, interval=interval
    )


def start_cards(
    messages: DataFrame, path: str, checkpoint: str, *, interval: str | None = CONSOLE_INTERVAL
) -> StreamingQuery:
    """Write one readable card per tweet, with the tweet's id, each card once.

    Cards are JSON lines, as a tweet may hold any sequence of line ends that
    could be put between cards.
    """
    return (
        tweet_cards(decode(messages))
        .writeStream.format("json")
        .outputMode("append")
        .queryName("cards")
        .option("path", path)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/cards")
        .trigger(**_trigger(interval))
        .start()
    )


def start_console(
    messages: DataFrame, output: Output, checkpoint: str, *, interval: str | None = CONSOLE_INTERVAL
) -> StreamingQuery:
    """Print a running count: the top 10 hashtags, or the 20 largest counts."""
    spark = messages.sparkSession
    counted = output.make(decode(messages, output.fields))
    writer = show_batch(10 if output is HASHTAGS else 20)
    with settings(spark, state_settings(spark, output)):
        return _start(
            counted,
            writer,
            mode="complete",
            name=f"{output.table}_console",
            checkpoint=checkpoint,
            interval=interval,
        )


def start_all(
    messages: DataFrame,
    store: Tables,
    checkpoint: str,
    *,
    stored_as: str = "current",
    interval: str | None = TABLE_INTERVAL,
    console: bool = False,
    console_interval: str | None = CONSOLE_INTERVAL,
) -> list[StreamingQuery]:
    """One query per output, and per console; each reads the source by itself."""
    queries: list[StreamingQuery] = []
    try:
        for output in RUNNING_COUNTS:
            queries.append(start_count(messages, output, store, checkpoint, stored_as=stored_as, interval=interval))
        queries.append(start_tweets(messages, store, checkpoint, interval=interval))
        for output in RUNNING_COUNTS if console else ():
            queries.append(start_console(messages, output, checkpoint, interval=console_interval))
    except Exception:
        for query in queries:
            query.stop()
        raise
    return queries


def start_shared(
    messages: DataFrame, store: Tables, checkpoint: str, *, interval: str | None = TABLE_INTERVAL
) -> StreamingQuery:
    """All four outputs from one query, which reads and decodes the source once."""
    fields = dict.fromkeys([*RAW.fields, *(name for output in RUNNING_COUNTS for name in output.fields)])
    judged = judge(messages, list(fields))
    counted = judged.observe(TAKEN_IN, F.count(F.lit(1)).alias("messages"), F.count(BAD).alias(BAD))
    return _start(
        counted,
        all_outputs(store),
        mode="append",
        name="all_outputs",
        checkpoint=checkpoint,
        interval=interval,
    )


def wait_any(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Wait until one query ends, then stop the others.

    If the one that ended has failed, its error is raised after they are.
    """
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait for queries that end by themselves; raises if one has failed."""
    queries = list(queries)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
