"""Tweet records as messages: JSON text in a column ``value``.

The topic reader and writer take any Spark source with that column. Kafka
needs its connector on the class path; text files serve as the topic otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chirpline.schema import TWEET

# A record missing a text cell may arrive as the bare JSON token
# NaN, which Spark decodes to these five characters.
NOT_A_NUMBER = '"NaN"'


def encode(records: DataFrame) -> DataFrame:
    """One JSON message per record; nulls are written out, not left out."""
    record = F.struct(*[name for name in TWEET.names if name in records.columns])
    return records.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def decode(messages: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Records out of messages, stamped with the time they were taken in.

    A message that is not valid JSON becomes a row of nulls; a field of the
    wrong type becomes null by itself. With ``fields`` only those are parsed.
    """
    wanted = StructType([TWEET[name] for name in (fields or TWEET.names)])
    parsed = messages.select(F.from_json(F.col("value").cast("string"), wanted).alias("data")).select("data.*")
    return parsed.select(*_cleaned(wanted), F.current_timestamp().alias("processing_time"))


def _cleaned(wanted: StructType, within: str = "") -> list[Column]:
    return [
        F.nullif(F.col(within + field.name), F.lit(NOT_A_NUMBER)).alias(field.name)
        if field.dataType == StringType()
        else F.col(within + field.name).alias(field.name)
        for field in wanted
    ]


# The column that takes in a text that is not all JSON of the schema, and what is known of a bad message.
CORRUPT = "_corrupt_record"
BAD = "undecodable"


def judge(messages: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """The records of ``decode``, with a column ``undecodable``, null for messages that can be decoded.

    A message cannot be decoded if it has no value, or its text is no JSON
    object and no field could be read from it. For such a message the column
    holds ``value`` (the text), ``origin`` (topic and partition, or the file)
    and ``position`` (its offset in the partition, null in a file). A field of
    the wrong type, or one that is missing, is no fault of the message.
    """
    wanted = StructType([TWEET[name] for name in (fields or TWEET.names)])
    text = F.col("value").cast("string")
    if {"topic", "partition", "offset"} <= set(messages.columns):
        origin, position = F.concat_ws("/", "topic", "partition"), F.col("offset")
    else:
        origin = F.col("origin") if "origin" in messages.columns else F.lit(None).cast("string")
        position = F.lit(None).cast("long")
    known = StructType([*wanted.fields, StructField(CORRUPT, StringType())])
    parsed = messages.select(
        F.from_json(text, known, {"columnNameOfCorruptRecord": CORRUPT}).alias("data"),
        text.alias("text"),
        origin.alias("origin"),
        position.alias("position"),
    )
    nothing = F.forall(F.array(*[F.col(f"data.{name}").isNull() for name in wanted.names]), lambda x: x)
    # Only what gave nothing is looked at again: it may be an object all the same.
    is_object = F.from_json("text", "map<string,string>").isNotNull()
    bad = F.col("text").isNull() | F.when(nothing & F.col(f"data.{CORRUPT}").isNotNull(), ~is_object).otherwise(
        F.col("data").isNull() | (F.trim("text") == "")
    )
    found = F.when(bad, F.struct(F.col("text").alias("value"), "origin", "position"))
    return parsed.select(*_cleaned(wanted, "data."), F.current_timestamp().alias("processing_time"), found.alias(BAD))


def undecodable(judged: DataFrame) -> DataFrame:
    """The messages that could not be decoded, out of ``judge``."""
    return judged.where(F.col(BAD).isNotNull()).select(f"{BAD}.*", "processing_time")


def publish_files(records: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Write records as text files of messages, one per partition.

    ``rows_per_file`` bounds the files, so that a stream over them can take in
    a partition in several batches.
    """
    writer = encode(records).write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.text(path)


def publish_topic(records: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send records to a Kafka topic. No key is set, so no partition runs hot."""
    encode(records).write.format("kafka").options(**topic_options(servers, **options)).option("topic", topic).save()


def topic_options(servers: str, **options: str) -> dict[str, str]:
    """Options common to reading and writing a topic."""
    return {"kafka.bootstrap.servers": servers, **options}


def subscribe_options(
    servers: str,
    topic: str,
    *,
    per_trigger: int | None = 1000,
    min_partitions: int | None = None,
    group: str | None = None,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    more: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a topic stream.

    ``per_trigger`` bounds the intake of one batch. ``min_partitions`` cuts the
    offset ranges of a batch into at least that many tasks, so that a topic
    partition holding most of the messages is read by many. A stream without a
    checkpoint begins at ``starting``. Offsets that the topic has lost are
    passed over unless ``fail_on_data_loss`` is set. ``more`` are any further
    options of the source, such as ``kafka.security.protocol``.
    """
    # Fixed values of the defaults: earliest start, lost offsets tolerated, 1000 offsets a trigger.
    options = {
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if group:
        options["kafka.group.id"] = group
    return topic_options(servers, **(options | (more or {})))


def stream_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Unbounded messages of a Kafka topic."""
    return spark.readStream.format("kafka").options(**subscribe_options(servers, topic, **options)).load()


def topic_range(spark: SparkSession, servers: str, topic: str, start: str, end: str, **options: str) -> DataFrame:
    """The messages between two places of a topic, as a stored batch has them, to read a batch again."""
    between = {"subscribe": topic, "startingOffsets": start or "earliest", "endingOffsets": end}
    return spark.read.format("kafka").options(**topic_options(servers, **between, **options)).load()


def stream_files(
    spark: SparkSession, path: str, per_trigger: int | None = None, *, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded messages of a folder of text files, each with its file as ``origin``.

    A batch takes in ``per_trigger`` files, or about ``bytes_per_trigger`` bytes
    of them where files differ in size.
    """
    reader = spark.readStream.format("text")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(path).select("value", F.col("_metadata.file_path").alias("origin"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a folder of text files, as a batch."""
    return spark.read.text(path)
