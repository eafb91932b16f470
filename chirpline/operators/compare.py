"""Streaming and batch counts side by side."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.functions.hashtags import without_hash
from chirpline.operators.counts import negative_by_airline
from chirpline.operators.ordering import top


def compare_counts(streaming: DataFrame, batch: DataFrame, *keys: str) -> DataFrame:
    """Per key: both counts, 0 where a side lacks the key, and their difference.

    This is the full outer join of the two count tables on null-safe keys,
    written as one grouping over their union: null is a group like any other,
    and a single partly aggregated shuffle takes the place of sorting both sides.
    """
    absent = F.lit(0).cast("long")
    left = streaming.select(*keys, F.col("count").alias("streaming_count"), absent.alias("batch_count"))
    right = batch.select(*keys, absent.alias("streaming_count"), F.col("count").alias("batch_count"))
    both = (
        left.unionByName(right)
        .groupBy(*keys)
        .agg(F.sum("streaming_count").alias("streaming_count"), F.sum("batch_count").alias("batch_count"))
    )
    return both.withColumn("delta", F.col("streaming_count") - F.col("batch_count"))


def compare_sentiment(streaming: DataFrame, batch: DataFrame) -> DataFrame:
    """Counts by sentiment."""
    return compare_counts(streaming.withColumnRenamed("sentiment", "airline_sentiment"), batch, "airline_sentiment")


def compare_negative_by_airline(streaming: DataFrame, batch: DataFrame) -> DataFrame:
    """Negative counts by airline, out of counts by airline and sentiment."""
    return compare_counts(negative_by_airline(streaming), negative_by_airline(batch), "airline")


def compare_hashtags(streaming: DataFrame, batch: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most used hashtags of each side, with both sides' counts of them.

    Batch keys lose one leading ``#`` so that both sides use the same keys. A
    key that only one side has among its first ``k`` shows what the other has
    counted all the same; 0 means that it has none.
    """
    streaming = streaming.withColumnRenamed("word", "hashtag")
    batch_tops = by_same_tag(top(batch, k))
    tags = F.broadcast(top(streaming, k).select("hashtag").union(batch_tops.select("hashtag")).distinct())  # 2 k rows
    batch = by_same_tag(batch)
    return compare_counts(
        streaming.join(tags, "hashtag", "left_semi"), batch.join(tags, "hashtag", "left_semi"), "hashtag"
    )


def by_same_tag(batch: DataFrame) -> DataFrame:
    """Counts of the batch rule under the tags of the message rule."""
    return batch.withColumnRenamed("word", "hashtag").withColumn("hashtag", without_hash(F.col("hashtag")))


def compare_all_hashtags(streaming: DataFrame, batch: DataFrame) -> DataFrame:
    """Every hashtag of either rule."""
    return compare_counts(streaming, by_same_tag(batch), "hashtag")
