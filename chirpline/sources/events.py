"""Tweets derived from the ``events`` table, which holds no tweet texts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chirpline.operators.records import CSV_NAMES

# One tweet per event. The statement runs unchanged in other SQL engines, so
# results over it can be checked there.
TWEETS_SQL = r"""
SELECT CAST(event_id AS STRING) AS tweet_id,
  CASE event_type WHEN 'error' THEN 'negative' WHEN 'purchase' THEN 'positive'
                  WHEN 'signup' THEN 'positive' ELSE 'neutral' END AS airline_sentiment,
  CAST(0.5 + (event_id % 50) / 100.0 AS FLOAT) AS airline_sentiment_confidence,
  CASE WHEN event_type = 'error' AND event_id % 3 <> 0
       THEN 'Reason' || CAST(event_id % 7 AS STRING) END AS negativereason,
  'Air' || CAST(user_id % 6 AS STRING) AS airline,
  'user' || CAST(user_id AS STRING) AS username,
  '@Air' || CAST(user_id % 6 AS STRING) ||
    CASE WHEN event_id % 5 = 0 THEN ' no tags'
         WHEN event_id % 11 = 0 THEN chr(10) || '#nl ##dbl # #' || event_type || ','
         ELSE ' #' || event_type || ' and #k' || CAST(user_id % 9 AS STRING) END AS tweet_text,
  substring(CAST(ts AS STRING), 1, 19) AS created_at,
  CAST(user_id % 4 AS INT) AS retweet_count,
  CASE WHEN event_id % 4 = 0 THEN NULL
       ELSE 'City' || CAST(user_id % 10 AS STRING) END AS tweet_location,
  CASE WHEN event_id % 6 = 0 THEN '' ELSE 'TZ' || CAST(user_id % 3 AS STRING) END AS user_timezone
FROM {events}
"""


def tweets_from(events: DataFrame) -> DataFrame:
    """Tweets with the field names of a record, less ``hashtags``."""
    return events.sparkSession.sql(TWEETS_SQL, events=events)


def csv_rows_from(events: DataFrame) -> DataFrame:
    """The same tweets with the column names of the CSV."""
    return tweets_from(events).withColumnsRenamed(CSV_NAMES)
