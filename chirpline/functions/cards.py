"""A tweet as one readable block of text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _required(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("None"))


def _optional(name: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit("N/A"))


def tweet_card() -> Column:
    """Card of ten labelled fields, one line each.

    Missing or empty optional fields show ``N/A``; a tweet without tags shows
    ``None``.
    """
    tags = F.when(F.size("hashtags") > 0, F.concat_ws(", ", "hashtags")).otherwise("None")
    # The labels and their order.
    labelled = [
        ("Tweet ID: ", _required("tweet_id")),
        ("Airline: ", _required("airline")),
        (
            "Sentiment: ",
            F.concat(
                _required("airline_sentiment"),
                F.lit(" (Confidence: "),
                _required("airline_sentiment_confidence"),
                F.lit(")"),
            ),
        ),
        ("Text: ", _required("tweet_text")),
        ("Created at: ", _required("created_at")),
        ("Retweets: ", _required("retweet_count")),
        ("Location: ", _optional("tweet_location")),
        ("Timezone: ", _optional("user_timezone")),
        ("Hashtags: ", tags),
        ("Reason (if negative): ", _optional("negativereason")),
    ]
    return F.concat_ws("\n", *[F.concat(F.lit(label), value) for label, value in labelled])
