"""Fewer, larger files for tables that a stream fills batch by batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chirpline.schema import ENDINGS, TABLES
from chirpline.sources import files
from chirpline.sources.tables import ParquetTables, fold
from chirpline.streaming.running import RAW, RUNNING_COUNTS

# The batch that holds what earlier batches have stored.
EARLIER = -1


def compact(store: ParquetTables, target: ParquetTables, stored_as: str, *, tweets: bool = False) -> None:
    """Copy the tables of a stopped stream, with earlier batches made one.

    Counts are folded. The raw tweets are many times as large and gain little,
    so they stay where they are unless ``tweets`` asks for a copy of them too.
    The stream may then go on from its checkpoint with ``target``. The last
    batch stays by itself, as the stream repeats it if it was stopped before
    marking it done. ``store`` is left as it is, so a copy that was broken off
    can be made again, into another folder: ``target`` must be empty, and
    neither folder may lie in the other.
    """
    spark = store.spark
    source, copy = (f"{files.qualified(spark, at.root)}/" for at in (store, target))
    if source.startswith(copy) or copy.startswith(source):
        raise ValueError(f"{target.root} and {store.root} must be folders apart")
    if not target.is_empty():
        raise ValueError(f"{target.root} is not empty")
    small = ("undecodable", "batch_ranges")
    copied = {RAW.table, *small}
    for table in small:
        _copy_batches(store, target, table, TABLES[table], lambda rows: rows)
    if tweets:
        _copy_batches(store, target, RAW.table, TABLES[RAW.table], lambda rows: rows)
    for output in RUNNING_COUNTS if stored_as != "current" else ():
        copied.add(output.table)
        if stored_as == "increments":
            _copy_log(store, target, output.table + ENDINGS[stored_as])
            continue
        _copy_batches(
            store,
            target,
            output.table + ENDINGS[stored_as],
            TABLES[output.table],
            lambda rows, output=output: fold(rows, output.table, stored_as),
        )
    for table in TABLES.keys() - copied:
        rows = store.read(table)
        if not rows.isEmpty():
            target.replace(rows, table)


def _copy_log(store: ParquetTables, target: ParquetTables, table: str) -> None:
    """Copy a log, folded; it knows its last batch, so that one is not added again."""
    log, copy, state = store.log(table), target.log(table), store.state()
    known = log.of(state)
    if known:
        name = f"base-{uuid.uuid4().hex}"
        copy.write_base(log.read(state), copy.buckets, name)
        target.manifest.change(lambda new: copy.name_base(new, name, known["last"]))


def _copy_batches(store: ParquetTables, target: ParquetTables, table: str, schema: StructType, make_one) -> None:
    rows = store.read_batches(table, schema)
    last = rows.agg(F.max("batch_id")).first()[0]
    if last is None:
        return

    def of(batches) -> DataFrame:
        return rows.where(batches).drop("batch_id")

    for batch_id, part in ((EARLIER, make_one(of(F.col("batch_id") < last))), (last, of(F.col("batch_id") == last))):
        if table in store.state().get("last", {}):
            target.write_batches({table: part}, batch_id)
        else:
            target.write_batch(part, table, batch_id)
