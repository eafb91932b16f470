"""What several operators share: staged tables, batches of bounded size, row keys."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpline.session import scratch, settings, work_dir

# Fixed value: the white space that separates words, as the contracts have it.
SPACES = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"

# Bytes of text that a task turns into Python objects at a time.
BLOCK_BYTES = 1 << 20

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Where Python workers run beside the driver, they find this package where it lies.
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, (known.get("PYTHONPATH"), root)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


@contextmanager
def staging(spark: SparkSession, purpose: str) -> Iterator[None]:
    """Removes what was staged within the block at its end.

    A result that still reads staged tables must have been written by then.
    """
    with scratch(spark, purpose) as path:
        token = _FOLDER.set(path)
        try:
            yield
        finally:
            _FOLDER.reset(token)


def staged(df: DataFrame, purpose: str, batch_rows: int | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back.

    Cuts lineage, so a lost executor costs no more than its own tasks.
    ``batch_rows`` bounds the rows handed to Python at a time. The rows of one
    value of ``by``, which must have few, can be read without the others.
    """
    spark, folder = df.sparkSession, _FOLDER.get()
    path = f"{folder}/{purpose}-{uuid.uuid4().hex}" if folder else work_dir(spark, purpose)
    with settings(spark, {BATCH_ROWS: str(batch_rows)} if batch_rows else {}):
        df.write.option("compression", "zstd").partitionBy(*[by] if by else []).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or what it takes to differ from all columns."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_of_each(docs: DataFrame, sha: str, chosen: DataFrame) -> DataFrame:
    """One row of ``docs``, without ``sha``, for each row of ``chosen``.

    ``chosen`` has three columns: an id, a value of ``sha``, and the number of
    rows of ``docs`` that have both; it should be staged. Where they are
    several, the one whose columns have the smallest hash stays.
    """
    columns = [x for x in docs.columns if x != sha]
    chosen = chosen.toDF(*(unused(docs, x) for x in ("_chosen_id", "_chosen_sha", "_chosen_n")))
    own_id, own_sha, n = chosen.columns
    same = docs["doc_id"].cast("long").eqNullSafe(chosen[own_id]) & (docs[sha] == chosen[own_sha])
    single = docs.join(chosen.filter(F.col(n) == 1), same, "left_semi").select(columns)
    several = chosen.filter(F.col(n) > 1)
    if several.isEmpty():
        return single
    row = F.struct(*columns)
    # Tasks reduce their own rows first, so rows that repeat very often are few when they meet.
    merged = (
        docs.join(several, same, "left_semi")
        .groupBy(sha)
        .agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("row"))
        .select("row.*")
    )
    return single.unionByName(merged)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``most`` bytes together, one row at least."""
    sizes = batch.column(column).fill_null(b"" if pa.types.is_binary(batch.column(column).type) else "")
    ends = np.cumsum(pa.compute.binary_length(sizes).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
