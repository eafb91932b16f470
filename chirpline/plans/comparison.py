"""The comparison of stored streaming and batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.operators.compare import by_same_tag, compare_counts, compare_negative_by_airline, compare_sentiment
from chirpline.plans.live import current_counts
from chirpline.schema import ENDINGS
from chirpline.sources.tables import Tables
from chirpline.streaming.running import AIRLINE, HASHTAGS, SENTIMENT

# Hashtags listed of each side, and hashtags charted.
HASHTAGS_LISTED = 10
HASHTAGS_CHARTED = 5

BATCH_TABLES = ("batch_sentiment_counts", "batch_hashtags", "batch_airline_sentiment")


def compare_top_hashtags(store: Tables, stored_as: str, *sizes: int) -> list[DataFrame]:
    """For each of ``sizes``, the first ``k`` hashtags of each side, with both sides' counts of them.

    Either side is asked once for the first rows of the largest size, which
    hold those of the others, and once for the keys that either has there, so
    that a database does the rest. These few rows are at the driver.
    """
    most = max(sizes)
    tops = store.read_top(HASHTAGS.table, most, stored_as), by_same_tag(store.read_top("batch_hashtags", most))
    tops = [[row["hashtag"] for row in side.collect()] for side in tops]
    tags = sorted({tag for side in tops for tag in side})
    compared = compare_counts(
        store.read_counts(HASHTAGS.table, tags, stored_as),
        by_same_tag(store.read_counts("batch_hashtags", [f"#{tag}" for tag in tags])),
        "hashtag",
    )
    compared = store.spark.createDataFrame(compared.collect(), compared.schema)
    return [compared.where(F.col("hashtag").isin([tag for side in tops for tag in side[:k]])) for k in sizes]


def comparisons(store: Tables, stored_as: str = "current") -> dict[str, DataFrame]:
    """All comparisons, whatever is stored: a side without a key counts 0.

    ``stored_as`` tells how the stream has stored its counts. Both sides are
    tables of counts, and of the hashtags only the top ones are compared, so
    the work does not grow with the tweets. All tables are read as of one
    moment, so beside a running ``--shared`` stream they hold the same batches.
    """
    store = store.snapshot()
    charted, listed = compare_top_hashtags(store, stored_as, HASHTAGS_CHARTED, HASHTAGS_LISTED)
    return {
        "sentiment": compare_sentiment(
            current_counts(store, SENTIMENT, stored_as), store.read("batch_sentiment_counts")
        ),
        "hashtags": charted,
        "hashtags_listed": listed,
        "negative_by_airline": compare_negative_by_airline(
            current_counts(store, AIRLINE, stored_as), store.read("batch_airline_sentiment")
        ),
    }


def never_written(store: Tables, stored_as: str = "current") -> list[str]:
    """The tables of either side that do not exist, so that zeros can be told from no run."""
    outputs = (HASHTAGS, AIRLINE) if stored_as == "increments" else (HASHTAGS, SENTIMENT, AIRLINE)
    wanted = [*(output.table + ENDINGS[stored_as] for output in outputs), *BATCH_TABLES]
    return [table for table in wanted if not store.exists(table)]
