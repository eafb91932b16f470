"""The batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.operators.counts import add_up, airline_sentiment_counts, word_counts
from chirpline.operators.ordering import by_airline, by_count, top
from chirpline.plans.metrics import record_run, timed
from chirpline.sources.tables import Tables


def store_counts(tweets: DataFrame, store: Tables, text: str = "tweet_text") -> int:
    """Write the three batch tables; the number of tweets is returned.

    The tweets are read twice, each time other columns: the text for the
    hashtags, airline and sentiment for the rest. Counts by sentiment and the
    total are sums over the stored counts by airline and sentiment. Readers
    find the three tables of one run, as they are exchanged together.
    """
    with store.together() as tables:
        tables.replace(word_counts(tweets, text), "batch_hashtags")
        tables.replace(airline_sentiment_counts(tweets), "batch_airline_sentiment")
        by_sentiment = add_up(tables.read("batch_airline_sentiment"), "airline_sentiment")
        tables.replace(by_sentiment, "batch_sentiment_counts")
    stored = store.read("batch_airline_sentiment")
    return stored.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count")).first()["count"]


def show_counts(store: Tables) -> None:
    """Print the batch tables: the top 10 hashtags, the first 20 rows of the others."""
    by_count(store.read("batch_sentiment_counts")).show()
    top(store.read("batch_hashtags"), 10).show()
    by_airline(store.read("batch_airline_sentiment")).show()


def run_batch(tweets: DataFrame, store: Tables, text: str = "tweet_text", *, show: bool = False) -> None:
    """Counts, tables and the metric row of one batch run. Errors are raised."""

    def work() -> int:
        records = store_counts(tweets, store, text)
        if show:
            show_counts(store)
        return records

    records, seconds = timed(work)
    record_run(tweets.sparkSession, store, "batch", records, seconds)
