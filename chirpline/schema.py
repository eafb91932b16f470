"""Record and table schemas shared by the batch and the streaming path."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The field names and types of a tweet message.
TWEET = StructType(
    [
        StructField("tweet_id", StringType()),
        StructField("airline_sentiment", StringType()),
        StructField("airline_sentiment_confidence", FloatType()),
        StructField("negativereason", StringType()),
        StructField("airline", StringType()),
        StructField("username", StringType()),
        StructField("tweet_text", StringType()),
        StructField("created_at", StringType()),
        StructField("retweet_count", IntegerType()),
        StructField("tweet_location", StringType()),
        StructField("user_timezone", StringType()),
        StructField("hashtags", ArrayType(StringType())),
    ]
)

# The columns kept in the raw tweet table.
KEY_FIELDS = [
    "tweet_id",
    "airline",
    "airline_sentiment",
    "tweet_text",
    "created_at",
    "retweet_count",
    "processing_time",
]


def counts(*keys: str) -> StructType:
    """Schema of a count table: string keys and a 64-bit ``count``."""
    fields = [StructField(key, StringType()) for key in keys]
    return StructType([*fields, StructField("count", LongType())])


METRIC = StructType(
    [
        StructField("processing_type", StringType()),
        StructField("records_processed", LongType()),
        StructField("processing_time_seconds", DoubleType()),
    ]
)

RAW_TWEETS = StructType(
    [
        StructField("processing_time", TimestampType()) if name == "processing_time" else TWEET[name]
        for name in KEY_FIELDS
    ]
)

# Messages that cannot be decoded: what they hold and where they were, a file
# or a topic and its partition, with the offset there.
UNDECODABLE = StructType(
    [
        StructField("value", StringType()),
        StructField("origin", StringType()),
        StructField("position", LongType()),
        StructField("processing_time", TimestampType()),
    ]
)

# What a batch of a stream has taken in: from one place of a source to another.
BATCH_RANGES = StructType(
    [
        StructField("query", StringType()),
        StructField("batch", LongType()),
        StructField("source", StringType()),
        StructField("start_offset", StringType()),
        StructField("end_offset", StringType()),
        StructField("messages", LongType()),
    ]
)

# Stored table names, with the columns of each; the last two are our own.
TABLES = {
    "batch_sentiment_counts": counts("airline_sentiment"),
    "batch_hashtags": counts("word"),
    "batch_airline_sentiment": counts("airline", "airline_sentiment"),
    "sentiment_counts": counts("airline_sentiment"),
    "hashtags": counts("hashtag"),
    "airline_sentiment": counts("airline", "airline_sentiment"),
    "tweets": RAW_TWEETS,
    "performance_metrics": METRIC,
    "undecodable": UNDECODABLE,
    "batch_ranges": BATCH_RANGES,
}


# How a running count is stored -> ending of its table's name.
ENDINGS = {"current": "", "history": "_history", "changes": "_changes", "increments": "_increments"}


def keys_of(table: str) -> list[str]:
    """Key columns of a count table."""
    return [name for name in TABLES[table].names if name != "count"]
