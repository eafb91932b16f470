import json
import math
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from chirpline.operators.records import shape_records, tweet_cards
from chirpline.schema import TWEET
from chirpline.sources.messages import (
    decode,
    encode,
    judge,
    publish_files,
    publish_topic,
    read_files,
    stream_topic,
    subscribe_options,
    topic_options,
    topic_range,
    undecodable,
)

CSV_ROW = {
    "tweet_id": 570306133677760513,
    "airline_sentiment": "negative",
    "airline_sentiment_confidence": 0.6842,
    "negativereason": None,
    "airline": "Air1",
    "name": "someone",
    "text": 'line one\n#two, "quoted" #three',
    "tweet_created": "2015-02-24 11:35:52 -0800",
    "retweet_count": 3,
    "tweet_location": "",
    "user_timezone": "TZ",
}


CSV_TYPES = {"tweet_id": "long", "airline_sentiment_confidence": "double", "retweet_count": "int"}


def csv_rows(spark, row=CSV_ROW):
    columns = [f"{name} {CSV_TYPES.get(name, 'string')}" for name in row]
    return spark.createDataFrame([tuple(row.values())], ", ".join(columns))


def messages(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def decoded(spark, text):
    return decode(messages(spark, text)).first()


def test_shape(spark):
    shaped = shape_records(csv_rows(spark))
    assert shaped.schema.simpleString() == TWEET.simpleString()
    row = shaped.first()
    assert row["tweet_id"] == "570306133677760513"
    assert row["airline_sentiment_confidence"] == pytest.approx(0.6842, abs=1e-6)
    assert (row["username"], row["created_at"]) == ("someone", "2015-02-24 11:35:52 -0800")
    assert row["hashtags"] == ["two,", "three"]


def test_shape_without_optional_columns_and_with_bad_values(spark):
    row = {k: v for k, v in CSV_ROW.items() if k not in ("negativereason", "tweet_location", "user_timezone")}
    row |= {"retweet_count": "many", "airline_sentiment_confidence": "high"}
    shaped = shape_records(spark.createDataFrame([row])).first()
    for name in ("negativereason", "tweet_location", "user_timezone", "retweet_count", "airline_sentiment_confidence"):
        assert shaped[name] is None


def test_missing_required_column_is_an_error(spark):
    rows = csv_rows(spark).drop("airline")
    with pytest.raises(Exception, match="airline"):
        shape_records(rows)


def test_encoded_message(spark):
    message = encode(shape_records(csv_rows(spark))).first()["value"]
    assert "\n" not in message
    record = json.loads(message)
    assert list(record) == TWEET.names
    assert record["negativereason"] is None
    assert record["tweet_text"] == CSV_ROW["text"]


def test_bytes_are_decoded(spark):
    as_bytes = messages(spark, '{"airline":"Ä"}').select(F.col("value").cast("binary").alias("value"))
    assert decode(as_bytes).first()["airline"] == "Ä"


def test_bare_nan(spark):
    row = decoded(spark, '{"negativereason": NaN, "airline": "A", "airline_sentiment_confidence": NaN}')
    assert row["negativereason"] is None
    assert row["airline"] == "A"
    assert math.isnan(row["airline_sentiment_confidence"])


@pytest.mark.parametrize("text", ["{bad", "", None])
def test_bad_message_is_a_row_of_nulls(spark, text):
    row = decoded(spark, text).asDict()
    assert row.pop("processing_time") is not None
    assert set(row.values()) == {None}


@pytest.mark.parametrize("value", ['"x"', "1.5"])
def test_wrong_type_nulls_one_field(spark, value):
    row = decoded(spark, f'{{"retweet_count": {value}, "airline": "A", "unknown": 1}}')
    assert (row["retweet_count"], row["airline"]) == (None, "A")


def test_fewer_fields_give_the_same_values(spark):
    texts = [
        '{"airline":"A","airline_sentiment":"negative","hashtags":["x",null]}',
        '{"airline":"A","airline_sentiment":"neutral","retweet_count":"x"}',
        '{"airline":"A","airline_sentiment":NaN,"tweet_text":"t"}',
        '{"airline":"A","airline_sentiment":"positive", broken',
        '{"airline":"A","airline_sentiment":"positive"} trailing',
        '{"airline":1,"airline_sentiment":["a"]}',
        '{"airline":"A","hashtags":"no array"}',
        '[{"airline":"A"}]',
        "{bad",
        "",
        None,
    ]
    df = messages(spark, *texts)
    full = decode(df).drop("processing_time")
    for fields in (["airline"], ["airline", "airline_sentiment"], ["hashtags"]):
        narrow = decode(df, fields).select(*fields).collect()
        assert narrow == full.select(*fields).collect()


def test_files_roundtrip(spark, tmp_path):
    records = shape_records(csv_rows(spark))
    publish_files(records, f"{tmp_path}/topic")
    back = decode(read_files(spark, f"{tmp_path}/topic")).drop("processing_time")
    assert back.collect() == records.collect()


def test_files_of_bounded_length(spark, tmp_path):
    records = spark.range(10, numPartitions=1).selectExpr("cast(id as string) AS tweet_id")
    publish_files(records, f"{tmp_path}/topic", 3)
    found = read_files(spark, f"{tmp_path}/topic")
    assert (len(found.inputFiles()), found.count()) == (4, 10)


def test_topic_options():
    assert subscribe_options("host:1", "t") == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }
    wide = subscribe_options("host:1", "t", per_trigger=None, min_partitions=64, group="g")
    assert "maxOffsetsPerTrigger" not in wide
    assert (wide["minPartitions"], wide["kafka.group.id"]) == ("64", "g")
    other = subscribe_options(
        "host:1", "t", starting="latest", fail_on_data_loss=True, more={"kafka.security.protocol": "SSL"}
    )
    assert (other["startingOffsets"], other["failOnDataLoss"]) == ("latest", "true")
    assert other["kafka.security.protocol"] == "SSL"
    assert topic_options("host:1", acks="all") == {"kafka.bootstrap.servers": "host:1", "acks": "all"}


def test_topic_reader_and_writer(spark):
    session = MagicMock()
    reader = session.readStream.format.return_value
    reader.options.return_value = reader
    assert stream_topic(session, "host:1", "t", per_trigger=5) is reader.load.return_value
    session.readStream.format.assert_called_once_with("kafka")
    reader.options.assert_called_once_with(**subscribe_options("host:1", "t", per_trigger=5))

    records = MagicMock(columns=TWEET.names)
    writer = records.select.return_value.write.format.return_value
    for call in ("option", "options"):
        getattr(writer, call).return_value = writer
    publish_topic(records, "host:1", "t")
    records.select.return_value.write.format.assert_called_once_with("kafka")
    writer.options.assert_called_once_with(**{"kafka.bootstrap.servers": "host:1"})
    writer.option.assert_called_once_with("topic", "t")
    writer.save.assert_called_once_with()


def test_card(spark):
    record = shape_records(csv_rows(spark, CSV_ROW | {"negativereason": "late"}))
    assert tweet_cards(record).first()["card"].split("\n") == [
        "Tweet ID: 570306133677760513",
        "Airline: Air1",
        "Sentiment: negative (Confidence: 0.6842)",
        "Text: line one",
        '#two, "quoted" #three',
        "Created at: 2015-02-24 11:35:52 -0800",
        "Retweets: 3",
        "Location: N/A",
        "Timezone: TZ",
        "Hashtags: two,, three",
        "Reason (if negative): late",
    ]


def test_card_of_a_message_of_nulls(spark):
    card = tweet_cards(decode(messages(spark, "{bad"))).first()["card"]
    assert "Airline: None\n" in card
    assert "Hashtags: None\n" in card
    assert card.endswith("Reason (if negative): N/A")


@pytest.mark.parametrize(
    ("text", "is_bad"),
    [
        ('{"tweet_id":"1"}', False),
        ("{}", False),
        ('{"unknown":1}', False),
        ('{"retweet_count":"x"}', False),
        ('{"tweet_id":"1","retweet_count":"x"}', False),
        ('{"tweet_id":NaN}', False),
        ("{broken", True),
        ('{"tweet_id":"1","airl', True),
        ('{"a":', True),
        ("", True),
        ("  ", True),
        ("[]", True),
        ('[{"tweet_id":"7"}]', True),
        ("5", True),
        ("null", True),
        (None, True),
    ],
)
def test_what_cannot_be_decoded(spark, text, is_bad):
    sent = spark.createDataFrame([(text,)], "value string")
    row = judge(sent).first()
    assert row["undecodable"] == ((text, None, None) if is_bad else None)
    assert row[:12] == decode(sent).first()[:12]


def test_undecodable_messages_keep_their_place_in_the_topic(spark):
    rows = [(b"{broken", "tweets", 3, 41), (b'{"tweet_id":"1"}', "tweets", 3, 42), (b"\xff", "tweets", 0, 7)]
    sent = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")
    found = undecodable(judge(sent, ["tweet_id"])).drop("processing_time")
    assert {tuple(row) for row in found.collect()} == {("{broken", "tweets/3", 41), ("�", "tweets/0", 7)}


def test_a_range_of_a_topic_can_be_read_again():
    spark = MagicMock()
    topic_range(spark, "host:9092", "tweets", '{"tweets":{"0":5}}', '{"tweets":{"0":9}}')
    options = spark.read.format.return_value.options.call_args.kwargs
    spark.read.format.assert_called_once_with("kafka")
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "tweets",
        "startingOffsets": '{"tweets":{"0":5}}',
        "endingOffsets": '{"tweets":{"0":9}}',
    }
