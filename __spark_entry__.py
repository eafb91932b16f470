"""Entry points: the flagship query, all queries, and the same results as SQL.

The given tables hold no tweets, so every query starts from one tweet per row
of ``events`` (``chirpline.sources.events``) and reads that table whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpline.operators import compare, counts, ordering, records
from chirpline.plans.batch import run_batch, store_counts
from chirpline.plans.comparison import comparisons
from chirpline.plans.live import current_counts, run_live
from chirpline.session import work_dir
from chirpline.sources import csv, files, messages
from chirpline.sources.events import TWEETS_SQL, csv_rows_from, tweets_from
from chirpline.sources.tables import ParquetTables
from chirpline.streaming.queries import finish, start_cards, start_count, start_shared, start_tweets
from chirpline.streaming.running import AIRLINE, HASHTAGS, SENTIMENT, Output

# The training-data operators and their pipeline are an extra: without them the rest works on.
EXTRA_QUERIES, EXTRA_SQL = {}, {}
try:
    from chirpline.llm import queries as llm

    EXTRA_QUERIES, EXTRA_SQL = dict(llm.QUERIES), llm.SQL
except ImportError:
    pass
try:
    import corpus_pipeline

    EXTRA_QUERIES["pipeline"] = corpus_pipeline.run
except ImportError:
    pass

SMOKE_DIR = "/root/testdata/sf0.001"

# A stream over staged messages has at least so many batches, whatever its size.
BATCHES = 3
# And as many more as it takes, for no batch has more than so many files of so many messages.
FILES_PER_BATCH = 1_000
ROWS_PER_FILE = 100_000


# ---- inputs -----------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets_from(events(spark, sf_dir))


def tweet_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.shape_records(csv_rows_from(events(spark, sf_dir)))


def joined_tags(rows: DataFrame) -> DataFrame:
    """The tag array as text, which hashes alike in every engine."""
    return rows.withColumn("hashtags", F.concat_ws("|", "hashtags"))


def topic(
    spark: SparkSession, sf_dir: str, work: str, batches: int = BATCHES, records: DataFrame | None = None
) -> DataFrame:
    """All tweets as a stream of messages, in ``batches`` batches or more."""
    path = f"{work}/topic"
    rows = events(spark, sf_dir).count()
    rows_per_file = max(1, min(ROWS_PER_FILE, rows // (2 * batches)))
    if records is None:
        messages.publish_files(tweet_records(spark, sf_dir), path, rows_per_file)
    else:
        records.write.option("maxRecordsPerFile", rows_per_file).text(path)
    n_files = sum(name.startswith("part-") for name in files.names(spark, path))
    # The most files with which there still are so many batches.
    return messages.stream_files(spark, path, max(1, min(FILES_PER_BATCH, (n_files - 1) // (batches - 1))))


# ---- streaming queries --------------------------------------------------------


def running_count(
    spark: SparkSession, sf_dir: str, output: Output, stored_as: str = "current"
) -> DataFrame:
    work = work_dir(spark, output.table)
    store = ParquetTables(spark, f"{work}/tables")
    query = start_count(
        topic(spark, sf_dir, work), output, store, f"{work}/checkpoints", stored_as=stored_as, interval=None
    )
    finish([query])
    return current_counts(store, output, stored_as)


def shared_tables(spark: SparkSession, sf_dir: str) -> ParquetTables:
    """What one reading stores in eight batches or more: a log of counts that was folded on the way."""
    work = work_dir(spark, "shared")
    store = ParquetTables(spark, f"{work}/tables", fold_after=3)
    finish([start_shared(topic(spark, sf_dir, work, 8), store, f"{work}/checkpoints", interval=None)])
    store.settle()
    return store


def shared_count(spark: SparkSession, sf_dir: str, output: Output) -> DataFrame:
    return current_counts(shared_tables(spark, sf_dir), output, "increments")


def shared_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All comparisons of one state of the tables, the counts being those of a log."""
    store = shared_tables(spark, sf_dir)
    store_counts(tweets(spark, sf_dir), store)
    return report_of(comparisons(store, "increments"))


def damaged_topic(spark: SparkSession, sf_dir: str, work: str) -> DataFrame:
    """The stream of all tweets, with every tenth message cut off in the middle."""
    encoded = messages.encode(tweet_records(spark, sf_dir))
    number = F.regexp_extract("value", r'"tweet_id":"(\d+)"', 1).cast("long")
    half = F.substring("value", F.lit(1), F.floor(F.length("value") / 2).cast("int"))
    cut = encoded.select(F.when(number % 10 == 0, half).otherwise(F.col("value")).alias("value"))
    return topic(spark, sf_dir, work, records=cut)


def stream_undecodable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each tweet is after a stream over damaged messages: with the tweets, or set aside."""
    work = work_dir(spark, "damaged")
    store = ParquetTables(spark, f"{work}/tables")
    run_live(spark, damaged_topic(spark, sf_dir, work), store, f"{work}/checkpoints", shared=True, interval=None)
    decoded = store.read("tweets").where("tweet_id IS NOT NULL")
    aside = store.read("undecodable").select(F.regexp_extract("value", r'"tweet_id":"(\d+)"', 1).alias("tweet_id"))
    return decoded.select("tweet_id", F.lit(True).alias("decoded")).unionByName(
        aside.withColumn("decoded", F.lit(False))
    )


def batch_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each stored batch has the messages of its range, and each range begins where the last one ended."""
    work = work_dir(spark, "ranges")
    store = ParquetTables(spark, f"{work}/tables")
    run_live(spark, topic(spark, sf_dir, work), store, f"{work}/checkpoints", shared=True, interval=None)
    ranges = store.read("batch_ranges")
    stored = store.read_batches("tweets").groupBy(F.col("batch_id").alias("batch")).count()
    ends = ranges.select((F.col("batch") + 1).alias("batch"), F.col("end_offset").alias("before"))
    joined = ranges.join(stored, "batch", "full").join(ends, "batch", "left")
    return joined.agg(
        F.sum("messages").alias("messages"),
        F.bool_and(F.col("messages").eqNullSafe(F.col("count"))).alias("agree"),
        F.bool_and((F.col("batch") == 0) | F.col("start_offset").eqNullSafe(F.col("before"))).alias("gapless"),
        (F.count("*") >= BATCHES).alias("several"),
    )


def message_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream over damaged messages says of its run."""
    work = work_dir(spark, "damaged")
    store = ParquetTables(spark, f"{work}/tables")
    run_live(spark, damaged_topic(spark, sf_dir, work), store, f"{work}/checkpoints", shared=True, interval=None)
    return store.read("performance_metrics").select("processing_type", "records_processed")


def stream_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_dir(spark, "tweets")
    store = ParquetTables(spark, f"{work}/tables")
    finish([start_tweets(topic(spark, sf_dir, work), store, f"{work}/checkpoints", interval=None)])
    return store.read("tweets").drop("processing_time")


def stream_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_dir(spark, "cards")
    finish([start_cards(topic(spark, sf_dir, work), f"{work}/cards", f"{work}/checkpoints", interval=None)])
    return spark.read.schema("tweet_id string, card string").json(f"{work}/cards")


# ---- other queries that store something first ----------------------------------


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark, 'messages')}/topic"
    messages.publish_files(tweet_records(spark, sf_dir), path)
    decoded = messages.decode(messages.read_files(spark, path)).drop("processing_time")
    return joined_tags(decoded)


def csv_large_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV columns with the types that are inferred from all records."""
    work = work_dir(spark, "csv")
    csv_rows_from(events(spark, sf_dir)).write.csv(f"{work}/csv", header=True, quote='"', escape='"')
    read = csv.read_large_csv(spark, f"{work}/csv", work, infer=True)
    return read.select(*read.columns, F.lit(", ".join(kind for _, kind in read.dtypes)).alias("types"))


def csv_roundtrip(spark: SparkSession, sf_dir: str, *, large: bool = False) -> DataFrame:
    work = work_dir(spark, "csv")
    rows = csv_rows_from(events(spark, sf_dir))
    rows.write.csv(f"{work}/csv", header=True, quote='"', escape='"')
    read = csv.read_large_csv(spark, f"{work}/csv", work) if large else csv.read_csv(spark, f"{work}/csv")
    return joined_tags(csv.land(records.shape_records(read), f"{work}/landed"))


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = ParquetTables(spark, f"{work_dir(spark, 'batch')}/tables")
    store_counts(tweets(spark, sf_dir), store)
    return store.read("batch_airline_sentiment")


def both_paths(spark: SparkSession, sf_dir: str, *, shared: bool = False) -> ParquetTables:
    """A store filled by the batch job and by the streaming job."""
    work = work_dir(spark, "both")
    store = ParquetTables(spark, f"{work}/tables")
    run_batch(tweets(spark, sf_dir), store)
    run_live(spark, topic(spark, sf_dir, work), store, f"{work}/checkpoints", shared=shared, interval=None)
    return store


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = both_paths(spark, sf_dir, shared=True).read("performance_metrics")
    took_time = (F.col("processing_time_seconds") > 0).alias("took_time")
    return rows.select("processing_type", "records_processed", took_time)


def comparison_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparisons of the stored tables, one below the other."""
    return report_of(comparisons(both_paths(spark, sf_dir)))


def report_of(compared: dict[str, DataFrame]) -> DataFrame:
    parts = [
        part.select(F.lit(name).alias("comparison"), F.col(part.columns[0]).alias("key"), *part.columns[1:])
        for name, part in compared.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def compare_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = counts.sentiment_counts(tweets(spark, sf_dir))
    return compare.compare_sentiment(running_count(spark, sf_dir, SENTIMENT), batch)


def compare_hashtags(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    batch = counts.word_counts(tweets(spark, sf_dir))
    return compare.compare_hashtags(running_count(spark, sf_dir, HASHTAGS), batch, k)


def compare_all_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = counts.word_counts(tweets(spark, sf_dir))
    return compare.compare_all_hashtags(running_count(spark, sf_dir, HASHTAGS), batch)


def compare_negative_by_airline(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = counts.airline_sentiment_counts(tweets(spark, sf_dir))
    return compare.compare_negative_by_airline(running_count(spark, sf_dir, AIRLINE), batch)


def sentiment_counts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    records.register(tweets(spark, sf_dir))
    return spark.sql("SELECT airline_sentiment, COUNT(*) AS count FROM tweets GROUP BY airline_sentiment")


# ---- entry points -------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Negative tweets by airline, streaming and batch side by side."""
    return compare_negative_by_airline(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # batch
        "tweet_count": lambda s, d: counts.tweet_count(tweets(s, d)),
        "sentiment_counts": lambda s, d: ordering.by_count(counts.sentiment_counts(tweets(s, d))),
        "sentiment_counts_view": sentiment_counts_view,
        "airline_sentiment_counts": lambda s, d: ordering.by_airline(counts.airline_sentiment_counts(tweets(s, d))),
        "hashtag_counts_batch": lambda s, d: counts.word_counts(tweets(s, d)),
        "hashtags_by_count_batch": lambda s, d: ordering.by_count(counts.word_counts(tweets(s, d))),
        "hashtag_top10_batch": lambda s, d: ordering.top(counts.word_counts(tweets(s, d)), 10),
        "first_hashtag": lambda s, d: records.with_first_hashtag(tweets(s, d)).select(
            "tweet_id", F.col("hashtags")[0].alias("first_hashtag")
        ),
        "table_roundtrip": table_roundtrip,
        # records and messages
        "csv_roundtrip": csv_roundtrip,
        "csv_large_roundtrip": lambda s, d: csv_roundtrip(s, d, large=True),
        "csv_large_inferred": csv_large_inferred,
        "tweet_records": lambda s, d: joined_tags(tweet_records(s, d)),
        "hashtag_array": lambda s, d: joined_tags(
            records.add_hashtags(tweets(s, d)).select("tweet_id", "hashtags")
        ),
        "json_roundtrip": json_roundtrip,
        "tweet_cards": lambda s, d: records.tweet_cards(tweet_records(s, d)),
        # streaming
        "stream_hashtag_counts": lambda s, d: running_count(s, d, HASHTAGS),
        "stream_sentiment_counts": lambda s, d: running_count(s, d, SENTIMENT),
        "stream_airline_sentiment": lambda s, d: running_count(s, d, AIRLINE),
        "stream_tweets": stream_tweets,
        "stream_cards": stream_cards,
        "snapshot_current": lambda s, d: running_count(s, d, SENTIMENT, "history"),
        "hashtag_changes_current": lambda s, d: running_count(s, d, HASHTAGS, "changes"),
        "shared_hashtag_counts": lambda s, d: shared_count(s, d, HASHTAGS),
        "shared_airline_sentiment": lambda s, d: shared_count(s, d, AIRLINE),
        "stream_undecodable": stream_undecodable,
        "message_metrics": message_metrics,
        "batch_ranges": batch_ranges,
        # stored results and comparison
        "negative_by_airline": lambda s, d: ordering.by_count(
            counts.negative_by_airline(counts.airline_sentiment_counts(tweets(s, d)))
        ),
        "hashtag_top10": lambda s, d: ordering.top(running_count(s, d, HASHTAGS), 10),
        "hashtag_top5": lambda s, d: ordering.top(running_count(s, d, HASHTAGS), 5),
        "compare_sentiment": compare_sentiment,
        "compare_negative_by_airline": compare_negative_by_airline,
        "compare_hashtags": compare_hashtags,
        "compare_hashtags_charted": lambda s, d: compare_hashtags(s, d, 5),
        "compare_all_hashtags": compare_all_hashtags,
        "comparison_report": comparison_report,
        "shared_comparison": shared_comparison,
        "run_metrics": run_metrics,
        **EXTRA_QUERIES,
    }


# ---- the same results as SQL ----------------------------------------------------

TWEETS = f"tweets AS ({TWEETS_SQL.format(events='events')})"

WORDS = """words AS (SELECT word, count(*) AS count
  FROM (SELECT unnest(string_split(tweet_text, ' ')) AS word FROM tweets)
  WHERE starts_with(word, '#') GROUP BY 1)"""

TAGS = r"""tags AS (SELECT word[2:] AS hashtag, count(*) AS count
  FROM (SELECT unnest(regexp_split_to_array(tweet_text, '\s+')) AS word FROM tweets)
  WHERE starts_with(word, '#') GROUP BY 1)"""

TAG_LIST = r"""list_transform(list_filter(
  regexp_split_to_array(tweet_text, '\s+'), lambda w: starts_with(w, '#')), lambda w: w[2:])"""

TAG_ARRAY = f"array_to_string({TAG_LIST}, '|')"

RECORDS = f"SELECT *, {TAG_ARRAY} AS hashtags FROM tweets"

# The labels of a card.
CARD = r"""'Tweet ID: ' || tweet_id
  || chr(10) || 'Airline: ' || airline
  || chr(10) || 'Sentiment: ' || airline_sentiment
  || ' (Confidence: ' || CAST(airline_sentiment_confidence AS VARCHAR) || ')'
  || chr(10) || 'Text: ' || tweet_text
  || chr(10) || 'Created at: ' || created_at
  || chr(10) || 'Retweets: ' || CAST(retweet_count AS VARCHAR)
  || chr(10) || 'Location: ' || coalesce(nullif(tweet_location, ''), 'N/A')
  || chr(10) || 'Timezone: ' || coalesce(nullif(user_timezone, ''), 'N/A')
  || chr(10) || 'Hashtags: ' || CASE len(hashtags) WHEN 0 THEN 'None' ELSE array_to_string(hashtags, ', ') END
  || chr(10) || 'Reason (if negative): ' || coalesce(nullif(negativereason, ''), 'N/A')"""


COMPARED = """coalesce(s.count, 0) AS streaming_count, coalesce(b.count, 0) AS batch_count,
      coalesce(s.count, 0) - coalesce(b.count, 0) AS delta"""


def _compared_hashtags(k: int) -> str:
    return f"""
      batch AS (SELECT word[2:] AS hashtag, count FROM words),
      asked AS (SELECT hashtag FROM (SELECT * FROM tags ORDER BY count DESC, hashtag LIMIT {k})
        UNION SELECT word[2:] FROM (SELECT * FROM words ORDER BY count DESC, word LIMIT {k}))
    SELECT hashtag, {COMPARED}
    FROM asked LEFT JOIN tags s USING (hashtag) LEFT JOIN batch b USING (hashtag)"""


def oracle_sql() -> dict[str, str]:
    by_sentiment = "SELECT airline_sentiment, count(*) AS count FROM tweets GROUP BY 1"
    by_airline = "SELECT airline, airline_sentiment, count(*) AS count FROM tweets GROUP BY 1, 2"
    negative = "SELECT airline, count(*) AS count FROM tweets WHERE airline_sentiment = 'negative' GROUP BY 1"
    same = "count(*) AS streaming_count, count(*) AS batch_count, CAST(0 AS BIGINT) AS delta"
    compared_sentiment = f"SELECT airline_sentiment, {same} FROM tweets GROUP BY 1"
    compared_airline = f"SELECT airline, {same} FROM tweets WHERE airline_sentiment = 'negative' GROUP BY 1"
    # an empty CSV cell is a missing value
    csv_records = RECORDS.replace("*", "* REPLACE (nullif(user_timezone, '') AS user_timezone)", 1)

    plain = {
        "tweet_count": "SELECT count(*) AS count FROM tweets",
        "sentiment_counts": by_sentiment,
        "sentiment_counts_view": by_sentiment,
        "airline_sentiment_counts": by_airline,
        "first_hashtag": r"SELECT tweet_id, regexp_extract(tweet_text, '(#\w+)', 1) AS first_hashtag FROM tweets",
        "table_roundtrip": by_airline,
        "csv_roundtrip": csv_records,
        "csv_large_roundtrip": csv_records,
        "tweet_records": RECORDS,
        "hashtag_array": f"SELECT tweet_id, {TAG_ARRAY} AS hashtags FROM tweets",
        "json_roundtrip": RECORDS,
        "stream_sentiment_counts": by_sentiment,
        "stream_airline_sentiment": by_airline,
        "stream_tweets": """SELECT tweet_id, airline, airline_sentiment, tweet_text, created_at, retweet_count
                            FROM tweets""",
        "snapshot_current": by_sentiment,
        "shared_airline_sentiment": by_airline,
        "negative_by_airline": negative,
        "compare_sentiment": compared_sentiment,
        "compare_negative_by_airline": compared_airline,
        "run_metrics": """SELECT 'batch' AS processing_type, count(*) AS records_processed, true AS took_time
                          FROM tweets
                          UNION ALL SELECT 'streaming', count(*), true FROM tweets""",
        "batch_ranges": """SELECT count(*) AS messages, true AS agree, true AS gapless, true AS several FROM tweets""",
        "stream_undecodable": "SELECT tweet_id, CAST(tweet_id AS BIGINT) % 10 <> 0 AS decoded FROM tweets",
        "message_metrics": """SELECT 'streaming' AS processing_type, count(*) AS records_processed FROM tweets
                              UNION ALL SELECT 'streaming_undecodable', count(*) FROM tweets
                              WHERE CAST(tweet_id AS BIGINT) % 10 = 0""",
        "csv_large_inferred": """SELECT CAST(tweet_id AS INT) AS tweet_id, airline_sentiment,
              CAST(airline_sentiment_confidence AS DOUBLE) AS airline_sentiment_confidence, negativereason, airline,
              username AS name, tweet_text AS text, CAST(created_at AS TIMESTAMP) AS tweet_created, retweet_count,
              tweet_location, nullif(user_timezone, '') AS user_timezone,
              'int, string, double, string, string, string, string, timestamp, int, string, string' AS types
            FROM tweets""",
    }
    with_words = {
        "hashtag_counts_batch": "SELECT * FROM words",
        "hashtags_by_count_batch": "SELECT * FROM words",
        "hashtag_top10_batch": "SELECT * FROM words ORDER BY count DESC, word LIMIT 10",
    }
    with_tags = {
        "stream_hashtag_counts": "SELECT * FROM tags",
        "hashtag_changes_current": "SELECT * FROM tags",
        "shared_hashtag_counts": "SELECT * FROM tags",
        "hashtag_top10": "SELECT * FROM tags ORDER BY count DESC, hashtag LIMIT 10",
        "hashtag_top5": "SELECT * FROM tags ORDER BY count DESC, hashtag LIMIT 5",
    }
    both = f"WITH {TWEETS}, {WORDS}, {TAGS}"
    records = f"WITH {TWEETS}, records AS (SELECT *, {TAG_LIST} AS hashtags FROM tweets)"
    report = f"""{both},
            hashtags AS (WITH {_compared_hashtags(5)}), hashtags_listed AS (WITH {_compared_hashtags(10)})
            SELECT 'sentiment' AS comparison, airline_sentiment AS key, * EXCLUDE (airline_sentiment)
              FROM ({compared_sentiment})
            UNION ALL SELECT 'hashtags', hashtag, * EXCLUDE (hashtag) FROM hashtags
            UNION ALL SELECT 'hashtags_listed', hashtag, * EXCLUDE (hashtag) FROM hashtags_listed
            UNION ALL SELECT 'negative_by_airline', airline, * EXCLUDE (airline) FROM ({compared_airline})"""
    return {
        **{name: f"WITH {TWEETS} {query}" for name, query in plain.items()},
        **{name: f"WITH {TWEETS}, {WORDS} {query}" for name, query in with_words.items()},
        **{name: f"WITH {TWEETS}, {TAGS} {query}" for name, query in with_tags.items()},
        "tweet_cards": f"{records} SELECT tweet_id, {CARD} AS card FROM records",
        "stream_cards": f"{records} SELECT tweet_id, {CARD} AS card FROM records",
        "compare_hashtags": f"{both}, {_compared_hashtags(10)}",
        "compare_hashtags_charted": f"{both}, {_compared_hashtags(5)}",
        "compare_all_hashtags": f"""{both} SELECT coalesce(s.hashtag, b.hashtag) AS hashtag, {COMPARED}
            FROM tags s FULL JOIN (SELECT word[2:] AS hashtag, count FROM words) b ON s.hashtag = b.hashtag""",
        "comparison_report": report,
        "shared_comparison": report,
        **EXTRA_SQL,
    }
