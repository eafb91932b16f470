"""Session set-up and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from chirpline.sources import files

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# State of a count whose keys may run into the millions: kept off the JVM heap,
# with only the changes of a batch uploaded at each commit.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, options: dict[str, str] | None = None) -> SparkSession:
    """Session with run-time re-planning on.

    Shuffles start with several partitions per core and are merged to a fitting
    size once their data is known. Anything in ``options`` takes precedence.
    """
    builder = SparkSession.builder.appName(app_name)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    for key, value in (defaults | (options or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if not spark.conf.get(initial, None):
        spark.conf.set(initial, str(max(200, 4 * spark.sparkContext.defaultParallelism)))
    return spark


def is_one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process; ``local-cluster`` has several."""
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A path for staged data that is removed at the end of the block."""
    path = work_dir(spark, purpose)
    try:
        yield path
    finally:
        files.remove(spark, path)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for staged data, below the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one machine, may go without.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not is_one_machine(spark):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="chirpline-")
    elif not is_one_machine(spark) and not re.match(r"(?!file:)[a-z][a-z0-9+.-]*:", shared):
        warnings.warn(f"{shared} names no shared file system: it must be mounted on all machines", stacklevel=2)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set session options for the length of a block.

    A streaming query takes a copy of the session as it starts, so wrapping
    the start is enough and the caller's session keeps its own options.
    """
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
