"""Shape of the plans: what is read, and what is shuffled."""

import pytest

import __spark_entry__ as entry_points
from chirpline.operators import counts
from chirpline.sources.messages import decode, read_files
from chirpline.streaming.running import RUNNING_COUNTS

SF_DIR = "/root/testdata/sf0.001"

LAZY = [
    "tweet_count",
    "sentiment_counts",
    "sentiment_counts_view",
    "airline_sentiment_counts",
    "hashtag_counts_batch",
    "hashtags_by_count_batch",
    "hashtag_top10_batch",
    "first_hashtag",
    "tweet_records",
    "hashtag_array",
    "tweet_cards",
    "negative_by_airline",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, name):
    return plan(entry_points.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_products(spark, name):
    text = query_plan(spark, name)
    for node in ("EvalPython", "MapInPandas", "Cartesian", "NestedLoop", "BroadcastExchange"):
        assert node not in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("tweet_count", "struct<>"),
        ("sentiment_counts", "struct<event_type:string>"),
        ("airline_sentiment_counts", "struct<user_id:bigint,event_type:string>"),
        ("hashtag_counts_batch", "struct<event_id:bigint,user_id:bigint,event_type:string>"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: {columns}\n" in query_plan(spark, name) + "\n"


@pytest.mark.parametrize("name", ["sentiment_counts", "airline_sentiment_counts", "hashtag_counts_batch"])
def test_tasks_count_before_the_shuffle(spark, name):
    text = query_plan(spark, name)
    assert text.index("hashpartitioning") < text.index("partial_count")


def test_top_needs_no_full_sort(spark):
    text = query_plan(spark, "hashtag_top10_batch")
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_negative_is_picked_before_counting(spark):
    text = query_plan(spark, "negative_by_airline")
    assert text.index("partial_count") < text.index("Filter")


@pytest.mark.parametrize("output", RUNNING_COUNTS, ids=lambda output: output.table)
def test_messages_are_parsed_once_and_for_few_fields(spark, tmp_path, output):
    (tmp_path / "0.json").write_text('{"airline":"A","airline_sentiment":"negative","hashtags":["x"]}\n')
    df = output.make(decode(read_files(spark, str(tmp_path)), output.fields))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
    assert "tweet_text" not in text


def test_counting_landed_records_reads_the_text_or_the_keys(spark, tmp_path):
    entry_points.tweet_records(spark, SF_DIR).write.parquet(f"{tmp_path}/records")
    records = spark.read.parquet(f"{tmp_path}/records")
    assert "ReadSchema: struct<tweet_text:string>" in plan(counts.word_counts(records))
    assert "ReadSchema: struct<hashtags:array<string>>" in plan(counts.tag_counts(records))
    by_airline = plan(counts.airline_sentiment_counts(records))
    assert "ReadSchema: struct<airline_sentiment:string,airline:string>" in by_airline
