"""From CSV rows to tweet records, and projections of records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from chirpline.functions.cards import tweet_card
from chirpline.functions.hashtags import first_tag, message_tags
from chirpline.schema import KEY_FIELDS, TWEET

# Record fields that have another name in the CSV.
CSV_NAMES = {"username": "name", "tweet_text": "text", "created_at": "tweet_created"}

# CSV columns that may be absent.
OPTIONAL = ["negativereason", "tweet_location", "user_timezone"]


def shape_records(rows: DataFrame) -> DataFrame:
    """Tweet records out of rows with the CSV's column names.

    A value that does not fit its type becomes null instead of failing the job.
    A whole number may be written as a decimal, such as ``1.0``.
    """

    def field(name: str) -> Column:
        source = CSV_NAMES.get(name, name)
        if name in OPTIONAL and source not in rows.columns:
            return F.lit(None).cast(TWEET[name].dataType).alias(name)
        value = F.col(source).try_cast(TWEET[name].dataType)
        if TWEET[name].dataType == IntegerType():
            number = F.col(source).try_cast("double")
            value = F.coalesce(value, F.when(number == F.floor(number), number.try_cast("int")))
        return value.alias(name)

    plain = [field(name) for name in TWEET.names if name != "hashtags"]
    return rows.select(*plain, message_tags(F.col("text")).alias("hashtags"))


def add_hashtags(tweets: DataFrame) -> DataFrame:
    """Add the ``hashtags`` array of the message rule to tweets."""
    return tweets.withColumn("hashtags", message_tags(F.col("tweet_text")))


def register(tweets: DataFrame, name: str = "tweets") -> None:
    """Make tweets known to SQL under a name, with the columns they have now."""
    tweets.createOrReplaceTempView(name)


def with_first_hashtag(tweets: DataFrame, text: str = "tweet_text") -> DataFrame:
    """Add ``hashtags``, an array holding the first tag only."""
    return tweets.withColumn("hashtags", first_tag(F.col(text)))


def key_fields(records: DataFrame) -> DataFrame:
    """The columns kept in the raw tweet table."""
    return records.select(*KEY_FIELDS)


def tweet_cards(records: DataFrame) -> DataFrame:
    """One readable card per tweet."""
    return records.select("tweet_id", tweet_card().alias("card"))
