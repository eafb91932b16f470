"""Small file operations on whatever file system a path names."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _found(spark: SparkSession, path: str):
    """The path and its file system, through Spark's own Hadoop client."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path in full, so that two ways to write it can be told to be one."""
    at, system = _found(spark, path)
    return system.makeQualified(at).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _found(spark, path)
    return system.exists(at)


def is_empty(spark: SparkSession, path: str) -> bool:
    """Whether a folder is missing or holds nothing."""
    at, system = _found(spark, path)
    return not system.exists(at) or len(system.listStatus(at)) == 0


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, by name; nothing if it is missing."""
    at, system = _found(spark, path)
    return [x.getPath().getName() for x in system.listStatus(at)] if system.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    at, system = _found(spark, path)
    system.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or ``None`` if there is none."""
    at, system = _found(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Make ``text`` the whole file in one step: readers see the old or the new one."""
    _rename(spark, _written(spark, path, text), path, "OVERWRITE")


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make ``text`` a file in one step, unless there is one; returns whether it did."""
    beside = _written(spark, path, text)
    try:
        _rename(spark, beside, path, "NONE")
        return True
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        remove(spark, beside)
        return False


def _written(spark: SparkSession, path: str, text: str) -> str:
    """The file beside ``path`` that holds ``text``."""
    beside = f"{path}.{uuid.uuid4().hex}"
    at, system = _found(spark, beside)
    stream = system.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return beside


def _rename(spark: SparkSession, source: str, target: str, option: str) -> None:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    at, system = _found(spark, source)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = getattr(kind, option)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(at, jvm.org.apache.hadoop.fs.Path(target), options)
