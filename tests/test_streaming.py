import glob
import json
import os
from unittest.mock import MagicMock

import hypothesis
import pytest
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException

import __spark_entry__ as entry_points
from chirpline.operators.counts import airline_sentiment_counts, sentiment_counts, tag_counts
from chirpline.operators.records import tweet_cards
from chirpline.plans.comparison import comparisons
from chirpline.plans.live import current_counts, run_live
from chirpline.plans.metrics import timed
from chirpline.plans.upkeep import compact
from chirpline.schema import KEY_FIELDS, TABLES
from chirpline.session import build_session, settings, work_dir
from chirpline.sources.messages import decode, read_files, stream_files
from chirpline.sources.tables import ParquetTables
from chirpline.streaming.progress import ProgressTotals
from chirpline.streaming.queries import (
    finish,
    start_all,
    start_cards,
    start_console,
    start_count,
    start_shared,
    start_tweets,
    state_settings,
    wait_any,
)
from chirpline.streaming.running import AIRLINE, HASHTAGS, RUNNING_COUNTS, SENTIMENT

BY_TABLE = {
    "hashtags": tag_counts,
    "sentiment_counts": sentiment_counts,
    "airline_sentiment": airline_sentiment_counts,
}

BATCHES = [
    [("1", "A", "negative", ["x", "y"]), ("2", "A", "neutral", []), ("2", "A", "neutral", None)],
    [("3", "B", "negative", ["x", ""]), ("4", None, None, [None])],
    [("5", "A", "negative", ["z"]), ("6", "B", "positive", ["x"])],
]


def write_batch(folder, number, rows, *more):
    names = ("tweet_id", "airline", "airline_sentiment", "hashtags")
    lines = [json.dumps(dict(zip(names, row))) for row in rows]
    path = f"{folder}/{number:05}.json"
    with open(path, "w") as file:
        file.write("\n".join([*lines, *more]) + "\n")
    os.utime(path, (number, number))


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    for number, rows in enumerate(BATCHES):
        write_batch(folder, number, rows, *(["{broken"] if number == 1 else []))
    return str(folder)


@pytest.fixture
def store(spark, tmp_path):
    return ParquetTables(spark, f"{tmp_path}/tables")


@pytest.fixture
def checkpoint(tmp_path):
    return f"{tmp_path}/checkpoints"


def as_set(df):
    return {tuple(row) for row in df.collect()}


def expected(spark, topic, output):
    return as_set(BY_TABLE[output.table](decode(read_files(spark, topic))))


@pytest.mark.parametrize("output", RUNNING_COUNTS, ids=lambda output: output.table)
@pytest.mark.parametrize("stored_as", ["current", "history", "changes"])
def test_stream_equals_batch(spark, topic, store, checkpoint, output, stored_as):
    query = start_count(stream_files(spark, topic, 1), output, store, checkpoint, stored_as=stored_as, interval=None)
    finish([query])
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert as_set(current_counts(store, output, stored_as)) == expected(spark, topic, output)


words = st.sampled_from(["x", "y", "", "ä", "NaN"])
random_row = st.tuples(
    st.none() | words,
    st.none() | words,
    st.none() | st.sampled_from(["negative", "neutral"]),
    st.none() | st.lists(st.none() | words, max_size=4),
)


@hypothesis.settings(max_examples=4, deadline=None, suppress_health_check=list(hypothesis.HealthCheck))
@hypothesis.given(st.lists(st.lists(random_row, max_size=8), min_size=1, max_size=4))
def test_stream_equals_batch_on_random_messages(spark, tmp_path_factory, batches):
    folder = tmp_path_factory.mktemp("random")
    (folder / "topic").mkdir()
    for number, rows in enumerate(batches):
        write_batch(folder / "topic", number, rows)
    topic, store = str(folder / "topic"), ParquetTables(spark, f"{folder}/tables")
    finish([start_shared(stream_files(spark, topic, 1), store, f"{folder}/checkpoints", interval=None)])
    finish([start_count(stream_files(spark, topic, 1), AIRLINE, store, f"{folder}/checkpoints", interval=None)])
    for output in RUNNING_COUNTS:
        assert as_set(current_counts(store, output, "increments")) == expected(spark, topic, output)
    assert as_set(current_counts(store, AIRLINE)) == expected(spark, topic, AIRLINE)
    assert store.read("tweets").count() == read_files(spark, topic).count()


def test_changes_hold_only_touched_keys(spark, topic, store, checkpoint):
    messages = stream_files(spark, topic, 1)
    finish([start_count(messages, SENTIMENT, store, checkpoint, stored_as="changes", interval=None)])
    finish([start_count(messages, SENTIMENT, store, checkpoint, stored_as="history", interval=None)])
    changes = store.read_batches("sentiment_counts_changes", TABLES["sentiment_counts"])
    history = store.read_batches("sentiment_counts_history", TABLES["sentiment_counts"])
    assert as_set(changes.where("batch_id = 2")) == {("negative", 3, 2), ("positive", 1, 2)}
    assert history.where("batch_id = 2").count() == 4


def test_all_outputs_from_one_query(spark, topic, store, checkpoint):
    finish([start_shared(stream_files(spark, topic, 1), store, checkpoint, interval=None)])
    for output in RUNNING_COUNTS:
        assert as_set(current_counts(store, output, "increments")) == expected(spark, topic, output)
    assert store.read("tweets").count() == 8


def test_raw_tweets_are_all_kept(spark, topic, store, checkpoint):
    query = start_tweets(stream_files(spark, topic, 1), store, checkpoint, interval=None)
    finish([query])
    stored = store.read("tweets")
    assert stored.columns == KEY_FIELDS
    ids = sorted(str(row["tweet_id"]) for row in stored.collect())
    assert ids == ["1", "2", "2", "3", "4", "5", "6", "None"]
    assert store.read_batches("tweets").select("batch_id", "processing_time").distinct().count() == 3


def test_restart_takes_up_where_it_ended(spark, topic, store, checkpoint):
    def run():
        messages = stream_files(spark, topic, 1)
        queries = [start_count(messages, output, store, checkpoint, interval=None) for output in RUNNING_COUNTS]
        queries.append(start_tweets(messages, store, checkpoint, interval=None))
        finish(queries)
        return sum(p.numInputRows for query in queries for p in query.recentProgress)

    assert run() == 4 * 8
    assert run() == 0
    write_batch(topic, 9, [("7", "C", "neutral", ["new"])])
    assert run() == 4
    for output in RUNNING_COUNTS:
        assert as_set(store.read(output.table)) == expected(spark, topic, output)
    assert store.read("tweets").count() == 9


class FailingOnce(ParquetTables):
    """Fails one write after its rows have been stored."""

    failures = 1

    def write_batch(self, rows, table, batch_id):
        super().write_batch(rows, table, batch_id)
        if batch_id == 1 and self.failures:
            self.failures -= 1
            raise OSError("table store is gone")


@pytest.mark.parametrize("start, table", [(start_tweets, "tweets"), (start_shared, "all_outputs")])
def test_a_failed_write_fails_the_query_and_is_repeated_once(spark, topic, tmp_path, checkpoint, start, table):
    store = FailingOnce(spark, f"{tmp_path}/tables")
    messages = stream_files(spark, topic, 1)
    with pytest.raises(StreamingQueryException, match="table store is gone"):
        finish([start(messages, store, checkpoint, interval=None)])
    assert sorted(os.path.basename(p) for p in glob.glob(f"{checkpoint}/{table}/commits/*")) == ["0"]
    finish([start(messages, store, checkpoint, interval=None)])
    assert store.read("tweets").count() == 8
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    if start is start_shared:
        assert as_set(current_counts(store, HASHTAGS, "increments")) == expected(spark, topic, HASHTAGS)


def test_intake_by_bytes(spark, topic, store, checkpoint):
    query = start_tweets(stream_files(spark, topic, bytes_per_trigger=1), store, checkpoint, interval=None)
    finish([query])
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert store.read("tweets").count() == 8


@pytest.mark.parametrize("stored_as", ["current", "history", "changes", "increments"])
def test_a_compacted_copy_holds_the_same_and_the_stream_goes_on(spark, topic, tmp_path, store, checkpoint, stored_as):
    def run(store):
        messages = stream_files(spark, topic, 1)
        if stored_as == "increments":
            finish([start_shared(messages, store, checkpoint, interval=None)])
        else:
            finish(start_all(messages, store, checkpoint, stored_as=stored_as, interval=None))

    def check(store, tweets):
        for output in RUNNING_COUNTS:
            assert as_set(current_counts(store, output, stored_as)) == expected(spark, topic, output)
        assert store.read("tweets").count() == tweets

    run(store)
    target = ParquetTables(spark, f"{tmp_path}/compacted")
    compact(store, target, stored_as, tweets=True)
    check(target, 8)
    batches = {row["batch_id"] for row in target.read_batches("tweets").collect()}
    assert batches == {-1, 2}

    # the last batch is repeated, as after a stop before it was marked done
    for commit in glob.glob(f"{checkpoint}/*/commits/2"):
        os.remove(commit)
    for commit in glob.glob(f"{checkpoint}/*/commits/.2.crc"):
        os.remove(commit)
    run(target)
    check(target, 8)

    write_batch(topic, 9, [("7", "C", "neutral", ["new", "x"])])
    run(target)
    check(target, 9)

    again = ParquetTables(spark, f"{tmp_path}/again")
    compact(target, again, stored_as, tweets=True)
    check(again, 9)


def test_compaction_leaves_the_raw_tweets(spark, topic, tmp_path, store, checkpoint):
    finish([start_shared(stream_files(spark, topic, 1), store, checkpoint, interval=None)])
    target = ParquetTables(spark, f"{tmp_path}/compacted")
    compact(store, target, "increments")
    assert not target.exists("tweets")
    assert as_set(current_counts(target, HASHTAGS, "increments")) == expected(spark, topic, HASHTAGS)


@pytest.mark.parametrize("into", ["tables", "tables/", "./tables", "tables/inner", "", "full"])
def test_compaction_refuses_a_target_that_could_harm(spark, topic, tmp_path, store, checkpoint, into):
    finish([start_shared(stream_files(spark, topic, 1), store, checkpoint, interval=None)])
    (tmp_path / "full").mkdir()
    (tmp_path / "full" / "kept").write_text("x")
    with pytest.raises(ValueError, match="folders apart|not empty"):
        compact(store, ParquetTables(spark, f"{tmp_path}/{into}"), "increments", tweets=True)
    assert store.read("tweets").count() == 8
    assert (tmp_path / "full" / "kept").exists()


def test_compacting_nothing_writes_nothing(spark, tmp_path, store):
    compact(store, ParquetTables(spark, f"{tmp_path}/compacted"), "changes")
    assert not os.path.exists(f"{tmp_path}/compacted")


def test_empty_batches_write_nothing(spark, tmp_path, store, checkpoint):
    folder = tmp_path / "quiet"
    folder.mkdir()
    write_batch(folder, 0, [("1", "A", "negative", [])])
    finish([start_count(stream_files(spark, str(folder)), HASHTAGS, store, checkpoint, interval=None)])
    assert not os.path.exists(store.path("hashtags"))
    assert store.read("hashtags").isEmpty()


def test_a_batch_without_messages_adds_no_tweets(spark, tmp_path, store, checkpoint):
    folder = tmp_path / "quiet"
    folder.mkdir()
    for number, rows in enumerate([[("1", "A", "negative", [])], [], [("2", "A", "negative", [])]]):
        write_batch(folder, number, rows)
    (folder / "00001.json").write_text("")
    os.utime(folder / "00001.json", (1, 1))
    for start in (start_tweets, start_shared):
        finish([start(stream_files(spark, str(folder), 1), store, checkpoint, interval=None)])
        assert sorted(row["tweet_id"] for row in store.read("tweets").collect()) == ["1", "2"]


def test_console_shows_the_top_hashtags(spark, topic, checkpoint, capfd):
    finish([start_console(stream_files(spark, topic), HASHTAGS, checkpoint, interval=None)])
    finish([start_console(stream_files(spark, topic), AIRLINE, checkpoint, interval=None)])
    shown = capfd.readouterr().out
    assert shown.index("|x      |3    |") < shown.index("|z      |1    |")
    assert "|A      |negative         |2    |" in shown


def test_console_reads_every_batch_to_its_end(spark, tmp_path, store, checkpoint):
    """With more groups than are printed, no state partition may be left out."""
    folder = tmp_path / "many"
    folder.mkdir()
    for number in range(3):
        rows = [(f"{number}-{i}", f"air{i}", f"s{i % 40}", [f"t{i}"]) for i in range(300)]
        write_batch(folder, number, rows)
    for output in RUNNING_COUNTS:
        messages = stream_files(spark, str(folder), 1)
        finish([start_console(messages, output, checkpoint, interval=None)])
        # The state that the console has left is complete: a count that goes on from it is right.
        with settings(spark, state_settings(spark, output)):
            state = spark.read.format("statestore").load(f"{checkpoint}/{output.table}_console")
            groups = state.selectExpr("key.*", "value.count AS n").collect()
        assert len(groups) == (40 if output is SENTIMENT else 300)
        assert sum(row["n"] for row in groups) == 900


def test_cards_of_any_text(spark, tmp_path, checkpoint):
    texts = ["plain", "a\n\nb", "ends\n", "\n\n", "", "a\r\nb", None, "x\u2028y"]
    folder = tmp_path / "topic"
    folder.mkdir()
    lines = [json.dumps({"tweet_id": str(i), "tweet_text": text}) for i, text in enumerate(texts)]
    (folder / "0.json").write_text("\n".join(lines) + "\n")
    finish([start_cards(stream_files(spark, str(folder)), f"{tmp_path}/cards", checkpoint, interval=None)])
    stored = spark.read.schema("tweet_id string, card string").json(f"{tmp_path}/cards").collect()
    made = tweet_cards(decode(read_files(spark, str(folder)))).collect()
    assert sorted(map(tuple, stored)) == sorted(map(tuple, made))
    assert len(stored) == len(texts)


def test_a_run_that_fails_has_no_metric_row(spark, topic, tmp_path, checkpoint):
    store = FailingOnce(spark, f"{tmp_path}/tables")
    with pytest.raises(StreamingQueryException, match="table store is gone"):
        run_live(spark, stream_files(spark, topic, 1), store, checkpoint, shared=True, interval=None)
    assert store.read("performance_metrics").isEmpty()


def test_a_late_end_event_costs_a_warning_only():
    query = MagicMock(runId="r")
    with pytest.warns(UserWarning, match="no end of query"):
        ProgressTotals().wait([query], timeout=0.01)


def test_every_query_at_once_until_one_ends(spark, topic, store, checkpoint):
    spark.streams.resetTerminated()
    messages = stream_files(spark, topic, 1)
    queries = start_all(messages, store, checkpoint, interval="1 second", console=True, console_interval="1 second")
    assert len(queries) == 7
    for query in queries:
        query.processAllAvailable()
    queries[0].stop()
    wait_any(spark, queries)
    assert not any(query.isActive for query in queries)
    for output in RUNNING_COUNTS:
        assert as_set(store.read(output.table)) == expected(spark, topic, output)


def test_a_query_that_cannot_start_stops_the_others(spark, topic, store, checkpoint):
    messages = stream_files(spark, topic, 1)
    running = start_tweets(messages, store, checkpoint, interval="1 second")
    with pytest.raises(Exception, match="(?i)already active|same name"):
        start_all(messages, store, f"{checkpoint}-2", interval="1 second")
    assert [query.name for query in spark.streams.active] == ["tweets"]
    running.stop()


def test_wait_any_raises_what_failed(spark, topic, tmp_path, checkpoint):
    spark.streams.resetTerminated()
    messages = stream_files(spark, topic, 1)
    queries = [
        start_tweets(messages, FailingOnce(spark, f"{tmp_path}/tables"), checkpoint, interval="1 second"),
        start_count(messages, SENTIMENT, ParquetTables(spark, f"{tmp_path}/tables"), checkpoint, interval="1 second"),
    ]
    with pytest.raises(StreamingQueryException, match="table store is gone"):
        wait_any(spark, queries)
    assert not any(query.isActive for query in queries)


@pytest.mark.parametrize("shared", [False, True])
def test_live_run_writes_one_metric_row(spark, topic, store, checkpoint, shared):
    run_live(spark, stream_files(spark, topic, 1), store, checkpoint, shared=shared, interval=None)
    metric, *bad = sorted(store.read("performance_metrics").collect())
    assert (metric["processing_type"], metric["records_processed"]) == ("streaming", 8)
    # one reading also counts the message that cannot be decoded
    assert [tuple(row)[:2] for row in bad] == [("streaming_undecodable", 1)] * shared
    assert metric["processing_time_seconds"] > 0


def test_large_state_is_kept_apart(spark):
    assert "stateStore.providerClass" in " ".join(state_settings(spark, HASHTAGS))
    assert "stateStore.providerClass" not in " ".join(state_settings(spark, SENTIMENT))
    assert state_settings(spark, HASHTAGS, 1000)["spark.sql.shuffle.partitions"] == "1000"


def test_settings_are_put_back(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    with settings(spark, {"spark.sql.shuffle.partitions": "3", "chirpline.test": "x"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.conf.get("chirpline.test", None) is None


def test_session_options():
    spark = build_session("again", {"spark.sql.session.timeZone": "Europe/Paris"})
    assert spark.conf.get("spark.sql.session.timeZone") == "Europe/Paris"
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 200
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@pytest.mark.parametrize(
    "master, shared, fits",
    [
        ("local[4]", None, True),
        ("local-cluster[2,1,1024]", None, False),
        ("yarn", None, False),
        ("yarn", "hdfs://n/x", True),
    ],
)
def test_work_folder_off_one_machine(master, shared, fits):
    session = MagicMock()
    session.sparkContext.master = master
    session.conf.get.return_value = shared
    if fits:
        assert work_dir(session, "x")
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(session, "x")


def test_a_local_folder_off_one_machine_is_warned_of():
    session = MagicMock()
    session.sparkContext.master = "yarn"
    session.conf.get.return_value = "file:///tmp/x"
    with pytest.warns(UserWarning, match="must be mounted"):
        work_dir(session, "x")


def test_work_folder_is_the_shared_one(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    assert os.path.dirname(first) == spark.conf.get("spark.checkpoint.dir")


def test_timed():
    result, seconds = timed(lambda: 5)
    assert result == 5
    assert seconds >= 0


def test_undecodable_messages_are_set_aside_and_counted(spark, topic, store, checkpoint):
    write_batch(topic, 7, [("8", "A", "neutral", ["x"])], "", "[1]", '{"airline":')
    run_live(spark, stream_files(spark, topic, 1), store, checkpoint, shared=True, interval=None)
    aside = store.read("undecodable").collect()
    assert sorted(row["value"] for row in aside) == sorted(["", "[1]", "{broken", '{"airline":'])
    assert {row["origin"].rsplit("/")[-1] for row in aside} == {"00001.json", "00007.json"}
    assert {row["batch_id"] for row in store.read_batches("undecodable").collect()} == {1, 3}
    metrics = {row["processing_type"]: row["records_processed"] for row in store.read("performance_metrics").collect()}
    assert metrics == {"streaming": 12, "streaming_undecodable": 4}
    assert store.read("tweets").count() == 12
    for output in RUNNING_COUNTS:
        assert as_set(current_counts(store, output, "increments")) == expected(spark, topic, output)


class Interleaved(ParquetTables):
    """Compares after every step of a write, as another reader might."""

    def look(self):
        found = comparisons(ParquetTables(self.spark, self.root), "increments")
        by_sentiment, by_airline = (
            {row[0]: row["streaming_count"] for row in found[name].collect()} for name in ("sentiment", "negative_by_airline")
        )
        tags = sum(row["streaming_count"] for row in found["hashtags_listed"].collect())
        self.seen.append((sum(by_sentiment.values()), by_sentiment.get("negative", 0), sum(by_airline.values()), tags))

    seen: list = []

    def log(self, table):
        log = super().log(table)
        plain = log.write_delta

        def write_delta(*args):
            self.look()
            done = plain(*args)
            self.look()
            return done

        log.write_delta = write_delta
        return log


def test_a_comparison_beside_a_running_stream_reads_one_batch_of_all_tables(spark, topic, tmp_path, checkpoint):
    store = Interleaved(spark, f"{tmp_path}/tables")
    store.seen = []
    finish([start_shared(stream_files(spark, topic, 1), store, checkpoint, interval=None)])
    store.look()
    # tweets, negative ones twice, uses of hashtags: after no batch, after one, two and three
    assert list(dict.fromkeys(store.seen)) == [(0, 0, 0, 0), (3, 1, 1, 2), (6, 2, 2, 4), (8, 3, 3, 6)]


def test_registered_streams_have_several_batches(spark):
    """At the smallest scale too, so that what they show is added up over batches."""
    sf_dir = "/root/testdata/sf0.001"
    work = work_dir(spark, "batches")
    query = start_tweets(
        entry_points.topic(spark, sf_dir, work), ParquetTables(spark, f"{work}/tables"), f"{work}/checkpoints", interval=None
    )
    finish([query])
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 3
    shared = entry_points.shared_tables(spark, sf_dir)
    log = shared.log("hashtags_increments").of(shared.state())
    assert log["last"] >= 7 and log["base"] and len(log["deltas"]) < 8


def test_state_is_read_again_in_every_batch(spark):
    """A running count over the registered topic ends with the counts of all batches, not of the last one."""
    sf_dir = "/root/testdata/sf0.001"
    work = work_dir(spark, "batches")
    store = ParquetTables(spark, f"{work}/tables")
    messages = entry_points.topic(spark, sf_dir, work)
    finish([start_count(messages, SENTIMENT, store, f"{work}/checkpoints", stored_as="history", interval=None)])
    history = store.read_batches("sentiment_counts_history", TABLES["sentiment_counts"])
    totals = {row["batch_id"]: row["total"] for row in history.groupBy("batch_id").agg({"count": "sum"}).toDF("batch_id", "total").collect()}
    assert len(totals) >= 3 and sorted(totals.values()) == [totals[batch] for batch in sorted(totals)]
    assert max(totals.values()) == entry_points.events(spark, sf_dir).count() > min(totals.values())


@pytest.mark.parametrize("shared", [False, True])
def test_batches_are_tied_to_what_they_took_in(spark, topic, store, checkpoint, shared):
    run_live(spark, stream_files(spark, topic, 1), store, checkpoint, shared=shared, interval=None)
    write_batch(topic, 9, [("7", "C", "neutral", ["new"])])
    run_live(spark, stream_files(spark, topic, 1), store, checkpoint, shared=shared, interval=None)
    ranges = sorted(store.read("batch_ranges").collect(), key=lambda row: row["batch"])
    assert [row["messages"] for row in ranges] == [3, 3, 2, 1]
    assert [json.loads(row["end_offset"])["logOffset"] for row in ranges] == [0, 1, 2, 3]
    assert [row["start_offset"] for row in ranges[1:]] == [row["end_offset"] for row in ranges[:-1]]
    assert {row["query"] for row in ranges} == {"all_outputs" if shared else "tweets"}
    stored = store.read_batches("tweets").groupBy("batch_id").count().collect()
    assert {row["batch_id"]: row["count"] for row in stored} == {row["batch"]: row["messages"] for row in ranges}


@pytest.mark.parametrize("start", [start_tweets, start_shared])
def test_tweets_are_merged_while_the_stream_runs(spark, tmp_path, checkpoint, start):
    """Every tweet once, in a few files, though batches go on while some are merged."""
    folder = tmp_path / "many"
    folder.mkdir()
    for number in range(12):
        write_batch(folder, number, [(f"{number}-{i}", "A", "negative", ["x"]) for i in range(3)])
    store = ParquetTables(spark, f"{tmp_path}/tables", merge_after=3)
    finish([start(stream_files(spark, str(folder), 1), store, checkpoint, interval=None)])
    store.settle()
    rows = store.read_batches("tweets").collect()
    assert sorted(row["tweet_id"] for row in rows) == sorted(f"{n}-{i}" for n in range(12) for i in range(3))
    assert all(row["tweet_id"].startswith(f"{row['batch_id']}-") for row in rows)
    merged = store.state()["merged"]["tweets"]
    assert merged["folders"] and merged["through"] >= 2
