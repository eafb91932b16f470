"""Counts by sentiment, by hashtag and by airline and sentiment.

Every count is a plain ``groupBy().count()``: each task first counts what it
has read, so a key that holds a third of all rows leaves a task as one row and
the shuffle carries keys, not tweets. A null key is a group of its own.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.functions.hashtags import space_words


def tweet_count(tweets: DataFrame) -> DataFrame:
    """Number of tweets, as one row."""
    return tweets.agg(F.count(F.lit(1)).alias("count"))


def sentiment_counts(tweets: DataFrame) -> DataFrame:
    """Tweets per sentiment."""
    return tweets.groupBy("airline_sentiment").count()


def airline_sentiment_counts(tweets: DataFrame) -> DataFrame:
    """Tweets per airline and sentiment."""
    return tweets.groupBy("airline", "airline_sentiment").count()


def hash_words(tweets: DataFrame, text: str = "tweet_text") -> DataFrame:
    """One row per space-separated word that starts with ``#``.

    Most tweets carry no ``#`` at all; they are passed over before the split.
    """
    words = tweets.where(F.col(text).contains("#")).select(F.explode(space_words(F.col(text))).alias("word"))
    return words.where(F.col("word").startswith("#"))


def word_counts(tweets: DataFrame, text: str = "tweet_text") -> DataFrame:
    """Uses of each hashtag by the batch rule."""
    return hash_words(tweets, text).groupBy("word").count()


def tag_rows(records: DataFrame) -> DataFrame:
    """One row per tag of the ``hashtags`` array; null tags are dropped.

    A plain ``explode`` makes Spark test the array for emptiness ahead of the
    step that yields it, and so parse every message twice. The outer one does
    not, and the null row it gives for no tags falls to the null filter.
    """
    return records.select(F.explode_outer("hashtags").alias("hashtag")).where(F.col("hashtag").isNotNull())


def tag_counts(records: DataFrame) -> DataFrame:
    """Uses of each hashtag by the message rule."""
    return tag_rows(records).groupBy("hashtag").count()


def negative_by_airline(counted: DataFrame) -> DataFrame:
    """Negative tweets per airline, from counts by airline and sentiment."""
    return counted.where(F.col("airline_sentiment") == "negative").select("airline", "count")


def add_up(counted: DataFrame, *keys: str) -> DataFrame:
    """Sum counts over fewer keys, or over the batches of a table of increments."""
    return counted.groupBy(*keys).agg(F.sum("count").alias("count"))


def newest(snapshots: DataFrame, *keys: str) -> DataFrame:
    """Current count per key out of stored snapshots or changes.

    Running counts only grow, so the largest value stored for a key is the one
    written last, and a snapshot stored twice changes nothing.
    """
    return snapshots.groupBy(*keys).agg(F.max("count").alias("count"))
