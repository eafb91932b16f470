import os
import threading
from collections import Counter
from functools import reduce
from unittest.mock import MagicMock

import duckdb
import pytest
from pyspark.sql import functions as F

from chirpline.plans.batch import run_batch, show_counts, store_counts
from chirpline.plans.comparison import comparisons, never_written
from chirpline.schema import ENDINGS, METRIC, TABLES
from chirpline.sources.tables import (
    COMMIT,
    JdbcTables,
    ParquetTables,
    committed,
    counts_query,
    current_counts,
    exists_query,
    hash_predicates,
    top_query,
)


@pytest.fixture
def store(spark, tmp_path):
    return ParquetTables(spark, f"{tmp_path}/tables")


def counted(spark, rows):
    return spark.createDataFrame(rows, "airline_sentiment string, count long")


def as_set(df):
    return {tuple(row) for row in df.collect()}


def test_replace_and_append(spark, store):
    store.replace(counted(spark, [("a", 1), ("b", 2)]), "sentiment_counts")
    store.replace(counted(spark, [("a", 3)]), "sentiment_counts")
    assert as_set(store.read("sentiment_counts")) == {("a", 3)}
    store.append(counted(spark, [("c", 4)]), "sentiment_counts")
    assert as_set(store.read("sentiment_counts")) == {("a", 3), ("c", 4)}


def test_a_repeated_batch_is_stored_once(spark, store):
    rows = counted(spark, [("a", 1), ("a", 1)])
    for batch_id in (0, 1, 1):
        store.write_batch(rows, "sentiment_counts", batch_id)
    assert sorted(tuple(row) for row in store.read_batches("sentiment_counts").collect()) == [
        ("a", 1, 0),
        ("a", 1, 0),
        ("a", 1, 1),
        ("a", 1, 1),
    ]
    assert store.read("sentiment_counts").columns == ["airline_sentiment", "count"]


@pytest.mark.parametrize("table", TABLES)
def test_missing_table_reads_as_empty(store, table):
    assert store.read(table).schema == TABLES[table]
    assert store.read(table).isEmpty()


def test_other_read_errors_are_raised(spark, store, tmp_path):
    (tmp_path / "tables" / "hashtags").mkdir(parents=True)
    (tmp_path / "tables" / "hashtags" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        store.read("hashtags").collect()


def test_read_top(spark, store):
    rows = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "hashtag string, count long")
    store.replace(rows, "hashtags")
    assert [tuple(row) for row in store.read_top("hashtags", 2).collect()] == [("b", 3), ("c", 3)]


def test_filters_reach_the_scan(spark, store):
    rows = spark.createDataFrame([("A", "negative", 1)], TABLES["airline_sentiment"])
    store.replace(rows, "airline_sentiment")
    found = store.read("airline_sentiment").where("airline_sentiment = 'negative'").select("airline", "count")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(airline_sentiment,negative)" in plan
    assert as_set(found) == {("A", 1)}


TWEETS = [("A", "negative", "x #a"), ("A", "negative", "#a #b"), ("B", None, None)]
TWEET_COLUMNS = "airline string, airline_sentiment string, text string"


def test_batch_job(spark, store, capfd):
    run_batch(spark.createDataFrame(TWEETS, TWEET_COLUMNS), store, text="text", show=True)
    assert as_set(store.read("batch_sentiment_counts")) == {("negative", 2), (None, 1)}
    assert as_set(store.read("batch_airline_sentiment")) == {("A", "negative", 2), ("B", None, 1)}
    assert as_set(store.read("batch_hashtags")) == {("#a", 2), ("#b", 1)}
    metric = store.read("performance_metrics").first()
    assert (metric["processing_type"], metric["records_processed"]) == ("batch", 3)
    assert metric["processing_time_seconds"] > 0
    assert "|  #a|    2|" in capfd.readouterr().out
    run_batch(spark.createDataFrame(TWEETS[:1], TWEET_COLUMNS), store, text="text")
    assert as_set(store.read("batch_sentiment_counts")) == {("negative", 1)}
    assert sorted(row["records_processed"] for row in store.read("performance_metrics").collect()) == [1, 3]


def test_batch_job_over_no_tweets(spark, store):
    assert store_counts(spark.createDataFrame([], TWEET_COLUMNS), store, text="text") == 0
    assert store.read("batch_hashtags").isEmpty()
    show_counts(store)


def test_a_failing_batch_job_raises_and_records_nothing(spark, store):
    broken = spark.createDataFrame(TWEETS, TWEET_COLUMNS).withColumn("airline", F.raise_error(F.lit("broken row")))
    with pytest.raises(Exception, match="broken row"):
        run_batch(broken.withColumn("airline", F.col("airline").cast("string")), store, text="text")
    assert store.read("performance_metrics").isEmpty()


def test_comparisons_count_0_where_a_side_has_nothing(spark, store):
    names = ["sentiment", "hashtags", "hashtags_listed", "negative_by_airline"]
    assert list(comparisons(store)) == names
    assert all(df.isEmpty() for df in comparisons(store).values())
    assert "batch_hashtags" in never_written(store)
    run_batch(spark.createDataFrame(TWEETS, TWEET_COLUMNS), store, text="text")
    store.replace(spark.createDataFrame([("A", "neutral", 1)], TABLES["airline_sentiment"]), "airline_sentiment")
    store.replace(counted(spark, [("negative", 1)]), "sentiment_counts")
    assert never_written(store) == ["hashtags"]
    found = {name: as_set(df) for name, df in comparisons(store).items()}
    assert found == {
        "sentiment": {("negative", 1, 2, -1), (None, 0, 1, -1)},
        "hashtags": {("a", 0, 2, -2), ("b", 0, 1, -1)},
        "hashtags_listed": {("a", 0, 2, -2), ("b", 0, 1, -1)},
        "negative_by_airline": {("A", 0, 2, -2)},
    }


def test_a_reader_keeps_the_table_it_began_with(spark, store):
    store.replace(counted(spark, [("a", 1)]), "sentiment_counts")
    begun = store.read("sentiment_counts")
    store.replace(begun.withColumn("count", F.col("count") + 1), "sentiment_counts")
    assert as_set(begun) == {("a", 1)}
    assert as_set(store.read("sentiment_counts")) == {("a", 2)}
    for n in range(3):
        store.replace(counted(spark, [("a", n)]), "sentiment_counts")
    versions = [name for name in os.listdir(store.path("sentiment_counts")) if name.startswith("version-")]
    assert len(versions) == 2


def test_a_replace_that_fails_leaves_the_table(spark, store):
    store.replace(counted(spark, [("a", 1)]), "sentiment_counts")
    broken = counted(spark, [("b", 2)]).withColumn("count", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        store.replace(broken, "sentiment_counts")
    assert as_set(store.read("sentiment_counts")) == {("a", 1)}


# ---- logs of counts and the manifest -------------------------------------------------

LOG = "hashtags_increments"


def added(spark, store, batch_id, rows):
    store.write_batch(spark.createDataFrame(rows, TABLES["hashtags"]), LOG, batch_id)


def now(store):
    return as_set(current_counts(store, "hashtags", "increments"))


def folders(store, kind):
    return sorted(x for x in os.listdir(store.path(LOG)) if x.startswith(kind))


def test_a_fold_changes_no_count(spark, tmp_path):
    store = ParquetTables(spark, f"{tmp_path}/tables", fold_after=0, buckets=8)
    total = Counter()
    for batch_id in range(5):
        rows = [(f"t{i % 7}" if i % 5 else None, i + batch_id) for i in range(batch_id, 30, batch_id + 1)]
        total.update({key: 0 for key, _ in rows})
        for key, n in rows:
            total[key] += n
        added(spark, store, batch_id, rows)
        if batch_id == 2:
            assert store.log(LOG).fold()
            assert store.log(LOG).of(store.state())["deltas"] == []
        assert now(store) == set(total.items())
    assert store.log(LOG).fold() and not store.log(LOG).fold()
    assert now(store) == set(total.items())
    assert len(folders(store, "base")) == 2  # the one before stays for readers that have begun


def test_a_fold_rewrites_only_touched_buckets(spark, tmp_path):
    store = ParquetTables(spark, f"{tmp_path}/tables", fold_after=0, buckets=16)
    log = store.log(LOG)
    added(spark, store, 0, [(f"t{i}", 1) for i in range(200)])
    log.fold()
    before = dict(log.of(store.state())["base"])
    added(spark, store, 1, [("t1", 5)])
    log.fold()
    after = log.of(store.state())["base"]
    changed = [b for b in after if after[b] != before[b]]
    assert len(changed) == 1
    assert sorted(os.listdir(f"{store.path(LOG)}/{after[changed[0]]}"))[-1] == f"part={changed[0]}"
    assert dict(now(store))["t1"] == 6 and len(now(store)) == 200


def test_a_fold_may_take_few_buckets_at_a_time(spark, tmp_path):
    store = ParquetTables(spark, f"{tmp_path}/tables", fold_after=0, buckets=4)
    log = store.log(LOG)
    want = Counter()
    for batch_id in range(6):
        rows = [(f"t{i}", 1) for i in range(batch_id * 3, batch_id * 3 + 20)]
        want.update(key for key, _ in rows)
        added(spark, store, batch_id, rows)
        log.fold(most=1)
        assert now(store) == set(want.items())
    through = log.of(store.state())["through"]
    assert min(through) < max(through) == 5
    while log.fold(most=1):
        assert now(store) == set(want.items())
    assert log.of(store.state())["through"] == [5] * 4 and not log.of(store.state())["deltas"]


@pytest.mark.parametrize("midway", ["write_base", "change"])
def test_a_fold_that_is_killed_changes_nothing(spark, tmp_path, monkeypatch, midway):
    store = ParquetTables(spark, f"{tmp_path}/tables", fold_after=0, buckets=4)
    added(spark, store, 0, [("a", 1), ("b", 2)])
    store.log(LOG).fold()
    added(spark, store, 1, [("a", 5), ("c", 1)])
    want = {("a", 6), ("b", 2), ("c", 1)}
    log = store.log(LOG)
    if midway == "write_base":
        plain = log.write_base

        def write_base(*args):
            plain(*args)
            raise KeyboardInterrupt

        monkeypatch.setattr(log, "write_base", write_base)
    else:
        changes, plain = [], log.manifest.change

        def change(make):
            changes.append(make)
            if len(changes) == 2:
                raise KeyboardInterrupt
            return plain(make)

        monkeypatch.setattr(log.manifest, "change", change)
    with pytest.raises(KeyboardInterrupt):
        log.fold()
    monkeypatch.undo()
    assert now(store) == want and len(folders(store, "base")) == 2
    added(spark, store, 2, [("c", 1)])
    assert store.log(LOG).fold()
    assert now(store) == want - {("c", 1)} | {("c", 2)}
    assert len(folders(store, "base")) == 2  # what the killed fold had left is gone


def test_batches_go_on_while_a_fold_runs(spark, tmp_path, monkeypatch):
    store = ParquetTables(spark, f"{tmp_path}/tables", fold_after=0, buckets=4)
    for batch_id in range(3):
        added(spark, store, batch_id, [("a", 1), (f"t{batch_id}", 1)])
    log = store.log(LOG)
    plain = log.write_base

    def write_base(*args):
        added(spark, store, 3, [("a", 1), ("late", 1)])
        plain(*args)

    monkeypatch.setattr(log, "write_base", write_base)
    begun = store.snapshot()
    assert log.fold()
    assert [batch for batch, _ in log.of(store.state())["deltas"]] == [3]
    assert now(store) == {("a", 4), ("t0", 1), ("t1", 1), ("t2", 1), ("late", 1)}
    assert now(begun) == {("a", 3), ("t0", 1), ("t1", 1), ("t2", 1)}


def test_of_two_folds_the_later_one_counts(spark, tmp_path, monkeypatch):
    store = ParquetTables(spark, f"{tmp_path}/tables", fold_after=0, buckets=4)
    added(spark, store, 0, [("a", 1), ("b", 1)])
    first, second = store.log(LOG), store.log(LOG)
    plain = first.write_base

    def write_base(*args):
        plain(*args)
        assert second.fold()

    monkeypatch.setattr(first, "write_base", write_base)
    assert not first.fold()
    assert now(store) == {("a", 1), ("b", 1)}


def test_a_log_is_folded_beside_its_batches(spark, tmp_path):
    store = ParquetTables(spark, f"{tmp_path}/tables", fold_after=3)
    for batch_id in range(8):
        added(spark, store, batch_id, [("a", 1), (f"t{batch_id % 2}", 1)])
    store.settle()
    log = store.log(LOG).of(store.state())
    assert len(log["deltas"]) < 8 and log["base"]
    assert now(store) == {("a", 8), ("t0", 4), ("t1", 4)}


def test_a_batch_counts_once_and_another_run_is_refused(spark, tmp_path):
    store = ParquetTables(spark, f"{tmp_path}/tables")
    for batch_id in (0, 1, 1):
        added(spark, store, batch_id, [("a", 1)])
    assert now(store) == {("a", 2)}
    with pytest.raises(ValueError, match="another run"):
        added(spark, store, 0, [("a", 1)])


def tweets_of(spark, *ids):
    names = TABLES["tweets"].names[1:]
    return spark.createDataFrame([(str(i), *[None] * len(names)) for i in ids], TABLES["tweets"])


def test_merged_batches_hold_each_row_once(spark, tmp_path):
    store = ParquetTables(spark, f"{tmp_path}/tables", merge_after=0)
    for batch_id in range(7):
        store.write_batches({"tweets": tweets_of(spark, batch_id, batch_id)}, batch_id)
        begun = store.snapshot().read_batches("tweets")
        if batch_id in (2, 5):
            assert store.merge_batches("tweets") and not store.merge_batches("tweets")
        rows = sorted((int(r["tweet_id"]), r["batch_id"]) for r in store.read_batches("tweets").collect())
        assert rows == [(n, n) for n in range(batch_id + 1) for _ in range(2)]
        assert begun.count() == len(rows)
    left = [x for x in os.listdir(store.path("tweets")) if not x.startswith("merged")]
    # the first merge's batches are gone; those of the second wait for readers that have begun
    assert sorted(left) == [f"batch_id={n}" for n in (2, 3, 4, 5, 6)]
    # the last batch may be repeated
    store.write_batches({"tweets": tweets_of(spark, 6, 6)}, 6)
    assert store.read("tweets").count() == 14


def test_a_merge_that_is_killed_changes_nothing(spark, tmp_path, monkeypatch):
    store = ParquetTables(spark, f"{tmp_path}/tables", merge_after=0)
    for batch_id in range(3):
        store.write_batches({"tweets": tweets_of(spark, batch_id)}, batch_id)

    def change(make):
        raise KeyboardInterrupt

    monkeypatch.setattr(store.manifest, "change", change)
    with pytest.raises(KeyboardInterrupt):
        store.merge_batches("tweets")
    monkeypatch.undo()
    assert store.read("tweets").count() == 3
    assert store.merge_batches("tweets")
    assert store.read("tweets").count() == 3


def test_changes_of_several_writers_all_count(spark, tmp_path):
    manifests = [ParquetTables(spark, f"{tmp_path}/tables").manifest for _ in range(4)]

    def work(manifest, who):
        for i in range(6):
            manifest.change(lambda state: state.setdefault("seen", []).append([who, i]))

    threads = [threading.Thread(target=work, args=(m, who)) for who, m in enumerate(manifests)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    state = manifests[0].load()
    assert state["number"] == 24 and sorted(state["seen"]) == sorted([who, i] for who in range(4) for i in range(6))
    assert len([x for x in os.listdir(manifests[0].path) if x.endswith(".json")]) == 20


def test_tables_replaced_together_are_seen_together(spark, store):
    store.replace(counted(spark, [("old", 1)]), "batch_sentiment_counts")
    with store.together() as tables:
        tables.replace(counted(spark, [("new", 2)]), "batch_sentiment_counts")
        assert as_set(tables.read("batch_sentiment_counts")) == {("new", 2)}
        assert as_set(store.read("batch_sentiment_counts")) == {("old", 1)}
    assert as_set(store.read("batch_sentiment_counts")) == {("new", 2)}
    with pytest.raises(KeyboardInterrupt), store.together() as tables:
        tables.replace(counted(spark, [("never", 3)]), "batch_sentiment_counts")
        raise KeyboardInterrupt
    assert as_set(store.read("batch_sentiment_counts")) == {("new", 2)}


@pytest.mark.parametrize("stored_as", ["current", "history", "changes", "increments"])
def test_top_and_named_counts_of_every_way_to_store(spark, store, stored_as):
    schema = TABLES["hashtags"]
    rows = [[("a", 1), ("b", 5)], [("a", 7), ("b", 6), ("c", 6)]]
    for batch_id, batch in enumerate(rows):
        df = spark.createDataFrame(batch, schema)
        if stored_as == "current":
            store.replace(df, "hashtags")
        else:
            store.write_batch(df, "hashtags" + ENDINGS[stored_as], batch_id)
    want = [("b", 11), ("a", 8)] if stored_as == "increments" else [("a", 7), ("b", 6)]
    assert [tuple(row) for row in store.read_top("hashtags", 2, stored_as).collect()] == want
    assert as_set(store.read_counts("hashtags", ["c", "x"], stored_as)) == {("c", 6)}


# ---- JDBC: no database is at hand, so the calls into Spark are looked at ----------


class TablesInMemory(JdbcTables):
    """The database replaced by one within this process, which runs the statements; ``ran`` lists them."""

    def __init__(self, spark):
        super().__init__(spark, "jdbc:none:", driver="none")
        self.db = duckdb.connect()
        self.ran = []
        self.failing = None

    def _write(self, rows, table, mode):
        incoming = rows.toArrow()
        self.db.register("incoming", incoming)
        if not self.exists(table):
            self.db.execute(f"CREATE TABLE {table} AS SELECT * FROM incoming LIMIT 0")
        elif mode == "overwrite":
            self.db.execute(f"DELETE FROM {table}")
        self.db.execute(f"INSERT INTO {table} SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _load(self, query=None, dbtable=None, **options):
        found = self.db.sql(query or f"SELECT * FROM {dbtable}").to_arrow_table()
        return self.spark.createDataFrame(found)

    def exists(self, table):
        return bool(self.db.sql(exists_query(table)).fetchall())

    def tables(self):
        return {name for (name,) in self.db.sql("SELECT table_name FROM information_schema.tables").fetchall()}

    def _connect(self):
        return Recorded(self)


class Recorded:
    """A connection as the driver would give it."""

    def __init__(self, store):
        self.store = store

    def run(self, text):
        self.store.ran.append(text)
        if self.store.failing and text.startswith(self.store.failing):
            raise OSError("connection lost")
        self.store.db.execute(text)

    def setAutoCommit(self, on):
        assert on is False
        self.run("BEGIN")

    def createStatement(self):
        return self

    def executeUpdate(self, text):
        self.run(text)

    def commit(self):
        self.run("COMMIT")

    def rollback(self):
        self.run("ROLLBACK")

    def close(self):
        pass


def test_jdbc_replace_moves_rows_in_one_transaction(spark):
    store = TablesInMemory(spark)
    store.replace(counted(spark, [("a", 1)]), "sentiment_counts")
    store.ran.clear()
    store.replace(counted(spark, [("a", 3), ("a", 3), (None, 2)]), "sentiment_counts")
    assert as_set(store.query("SELECT * FROM sentiment_counts")) == {("a", 3), (None, 2)}
    assert store.db.sql("SELECT count(*) FROM sentiment_counts").fetchall() == [(2,)]
    words = [x.split()[0] for x in store.ran]
    assert words == ["BEGIN", "DELETE", "INSERT", "COMMIT", "BEGIN", "DROP", "COMMIT"]
    assert store.tables() == {"sentiment_counts"}


@pytest.mark.parametrize("failing", ["DELETE", "INSERT", "COMMIT"])
def test_jdbc_replace_that_fails_leaves_the_table(spark, failing):
    store = TablesInMemory(spark)
    store.replace(counted(spark, [("a", 1)]), "sentiment_counts")
    store.failing = failing
    with pytest.raises(OSError, match="connection lost"):
        store.replace(counted(spark, [("b", 2)]), "sentiment_counts")
    assert as_set(store.read("sentiment_counts")) == {("a", 1)}
    store.failing = None
    store.replace(counted(spark, [("b", 2)]), "sentiment_counts")
    assert as_set(store.read("sentiment_counts")) == {("b", 2)}


def test_jdbc_rows_that_fail_never_reach_the_table(spark):
    store = TablesInMemory(spark)
    store.replace(counted(spark, [("a", 1)]), "sentiment_counts")
    broken = counted(spark, [("b", 2)]).withColumn("count", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        store.replace(broken, "sentiment_counts")
    assert as_set(store.read("sentiment_counts")) == {("a", 1)}


def test_jdbc_batch_tables_are_exchanged_together(spark):
    store = TablesInMemory(spark)
    store_counts(spark.createDataFrame(TWEETS, TWEET_COLUMNS), store, text="text")
    store.ran.clear()
    store_counts(spark.createDataFrame(TWEETS[:1], TWEET_COLUMNS), store, text="text")
    moved = [x.split()[2] for x in store.ran[: store.ran.index("COMMIT")] if x.startswith("INSERT")]
    assert moved == ["batch_hashtags", "batch_airline_sentiment", "batch_sentiment_counts"]
    assert as_set(store.read("batch_sentiment_counts")) == {("negative", 1)}
    assert store.tables() == set(moved)


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("columns", [["airline"], ["airline", "airline_sentiment"]])
def test_hash_predicates_cover_each_row_once(columns, parts):
    """Run by a database, over nulls, empty texts and quotes, with hashes of either sign."""
    db = duckdb.connect()
    db.execute("CREATE TABLE t (airline VARCHAR, airline_sentiment VARCHAR, n INT)")
    values = [None, "", "a", "it's", "é", *[f"Air{i}" for i in range(200)]]
    db.executemany("INSERT INTO t VALUES (?, ?, ?)", [(a, b, i) for i, a in enumerate(values) for b in (None, "", "x")])
    predicates = hash_predicates(columns, parts, "(CAST(hash({}) % 2001 AS BIGINT) - 1000)")
    assert len(predicates) == parts
    met = " + ".join(f"CAST(({x}) AS INT)" for x in predicates)
    assert db.sql(f"SELECT DISTINCT {met} FROM t").fetchall() == [(1,)]
    sizes = [db.sql(f"SELECT count(*) FROM t WHERE {x}").fetchall()[0][0] for x in predicates]
    assert sum(sizes) == 3 * len(values) and max(sizes) <= 3 * sum(sizes) / parts


def test_jdbc_plain_table_is_read_in_parts(spark, monkeypatch):
    store = TablesInMemory(spark)
    store.hash_of = "CAST(hash({}) % 1000 AS BIGINT)"
    store.replace(counted(spark, [("a", 1), (None, 2), ("c", 3)]), "sentiment_counts")
    asked = []

    def load_parts(self, table, predicates):
        asked.append(predicates)
        parts = [self._load(query=f"SELECT * FROM {table} WHERE {x}") for x in predicates]
        return reduce(lambda a, b: a.unionByName(b), parts)

    monkeypatch.setattr(TablesInMemory, "_load_parts", load_parts)
    assert as_set(store.read("sentiment_counts", parts=4)) == {("a", 1), (None, 2), ("c", 3)}
    assert asked == [hash_predicates(["airline_sentiment"], 4, store.hash_of)]


def test_jdbc_parts_reach_spark(spark, monkeypatch):
    reader = MagicMock()
    monkeypatch.setenv("JDBC_PASSWORD", "secret")
    store = JdbcTables(MagicMock(read=reader), "jdbc:postgresql://db/tweets")
    store._load_parts("hashtags", ["a", "b"])
    known = {"driver": "org.postgresql.Driver", "user": "postgres", "password": "secret"}
    reader.jdbc.assert_called_once_with("jdbc:postgresql://db/tweets", "hashtags", predicates=["a", "b"], properties=known)


def test_jdbc_snapshot_ends_with_the_last_batch_of_all_tables(spark):
    store = TablesInMemory(spark)
    tags = TABLES["hashtags"]
    for batch_id in (0, 1):
        store.write_batch(spark.createDataFrame([("x", 1)], tags), "hashtags_increments", batch_id)
    air = spark.createDataFrame([("A", "negative", 1)], TABLES["airline_sentiment"])
    store.write_batch(air, "airline_sentiment_increments", 0)
    then = store.snapshot()
    assert as_set(current_counts(then, "hashtags", "increments")) == {("x", 1)}
    assert as_set(then.read_top("hashtags", 1, "increments")) == {("x", 1)}
    assert as_set(then.read_counts("hashtags", ["x"], "increments")) == {("x", 1)}
    assert as_set(store.read_counts("hashtags", ["x"], "increments")) == {("x", 2)}


def test_jdbc_write_options(spark, monkeypatch):
    monkeypatch.setenv("JDBC_PASSWORD", "secret")
    rows = MagicMock()
    dealt = rows.repartition.return_value
    writer = dealt.write.format.return_value
    for call in ("option", "options", "mode"):
        getattr(writer, call).return_value = writer
    JdbcTables(spark, "jdbc:postgresql://db/tweets", connections=4)._write(rows, "batch_hashtags", "overwrite")
    rows.repartition.assert_called_once_with(4)
    dealt.write.format.assert_called_once_with("jdbc")
    writer.options.assert_called_once_with(
        url="jdbc:postgresql://db/tweets", driver="org.postgresql.Driver", user="postgres", password="secret"
    )
    assert {call.args for call in writer.option.call_args_list} == {
        ("dbtable", "batch_hashtags"),
        ("numPartitions", 4),
        ("truncate", "true"),
    }
    writer.mode.assert_called_once_with("overwrite")
    writer.save.assert_called_once_with()


def test_jdbc_query_and_table_options(spark, monkeypatch):
    loaded = []
    frame = counted(spark, [("a", 1)])
    monkeypatch.setattr(JdbcTables, "_load", lambda self, **options: loaded.append(options) or frame)
    monkeypatch.setattr(JdbcTables, "exists", lambda self, table: not table.endswith("_commits"))
    store = JdbcTables(spark, "jdbc:postgresql://db/tweets")
    store.query("SELECT 1")
    store.read("sentiment_counts", numPartitions="4")
    store.read_top("sentiment_counts", 10)
    assert loaded == [
        {"query": "SELECT 1"},
        {"dbtable": "sentiment_counts", "numPartitions": "4"},
        {"query": top_query("sentiment_counts", ["airline_sentiment"], 10)},
    ]
    loaded.clear()
    store.read_top("hashtags", 10, "changes")
    store.read_counts("hashtags", ["it's"], "increments")
    assert loaded == [
        {"query": top_query("hashtags_changes", ["hashtag"], 10, "changes")},
        {"query": counts_query("hashtags_increments", ["hashtag"], "increments", ["it's"])},
    ]


def test_jdbc_existence_is_asked_of_the_database(spark, monkeypatch):
    loaded = []
    monkeypatch.setattr(JdbcTables, "_load", lambda self, **options: loaded.append(options) or spark.range(1))
    assert JdbcTables(spark, "jdbc:postgresql://db/tweets").exists("hashtags")
    assert loaded == [{"query": exists_query("hashtags")}]


def test_jdbc_batches_are_read_over_several_connections(spark, monkeypatch):
    asked = []
    commits = spark.createDataFrame([(3, "x"), (9, "y")], COMMIT)
    rows = spark.createDataFrame([("a", 1, 3, "x", 0)], "hashtag string, count long, batch_id long, attempt string, row_id long")

    def load(self, **options):
        asked.append(options)
        return commits if options["dbtable"].endswith("_commits") else rows

    monkeypatch.setattr(JdbcTables, "_load", load)
    monkeypatch.setattr(JdbcTables, "exists", lambda self, table: True)
    found = JdbcTables(spark, "jdbc:postgresql://db/x", connections=4).read_batches("hashtags")
    assert asked[-1] == {
        "dbtable": "hashtags",
        "partitionColumn": "batch_id",
        "lowerBound": "3",
        "upperBound": "10",
        "numPartitions": "4",
    }
    assert as_set(found) == {("a", 1, 3)}


@pytest.mark.parametrize("stored_as", ["changes", "increments"])
def test_the_database_counts_as_spark_does(spark, stored_as):
    """The statements, run by another SQL engine on the same rows."""
    schema = "hashtag string, count long, batch_id long, attempt string, row_id long"
    rows = [("a", 4, 0, "x", 0), ("a", 4, 0, "x", 0), ("a", 9, 0, "z", 0), ("b", 2, 1, "y", 0), ("a", 5, 1, "y", 1)]
    rows += [("a'", 1, 1, "y", 2), ("c", 9, 2, "never", 0)]
    commits = [(0, "x"), (0, "z"), (1, "y")]
    store = TablesInMemory(spark)
    store._write(spark.createDataFrame(rows, schema), f"hashtags_{stored_as}", "append")
    store._write(spark.createDataFrame(commits, COMMIT), f"hashtags_{stored_as}_commits", "append")
    con = store.db
    want = as_set(current_counts(store, "hashtags", stored_as))
    table = f"hashtags_{stored_as}"
    assert set(con.execute(counts_query(table, ["hashtag"], stored_as)).fetchall()) == want
    tops = con.execute(top_query(table, ["hashtag"], 2, stored_as)).fetchall()
    assert tops == sorted(want, key=lambda row: (-row[1], row[0]))[:2]
    some = con.execute(counts_query(table, ["hashtag"], stored_as, ["b", "a'"])).fetchall()
    assert set(some) == {row for row in want if row[0] in ("b", "a'")}


def test_jdbc_raw_tweets_are_those_of_finished_batches(spark):
    store = TablesInMemory(spark)
    names = ", ".join(f"cast(null as {f.dataType.simpleString()}) AS {f.name}" for f in TABLES["tweets"].fields[1:])
    rows = spark.range(3).selectExpr("cast(id as string) AS tweet_id", *names.split(", "))
    store.write_batch(rows, "tweets", 0)
    unfinished = store._load(dbtable="tweets").withColumn("attempt", F.lit("lost"))
    store._write(unfinished, "tweets", "append")
    assert store.read("tweets").count() == 3


def test_jdbc_queries():
    assert exists_query("s.hashtags").endswith("table_name = 'hashtags' AND table_schema = 's'")
    assert exists_query("hashtags") == "SELECT 1 AS found FROM information_schema.tables WHERE table_name = 'hashtags'"
    assert top_query("hashtags", ["hashtag"], 10) == (
        'SELECT "hashtag", MAX("count") AS "count" FROM hashtags '
        'GROUP BY "hashtag" ORDER BY "count" DESC, "hashtag" LIMIT 10'
    )


def test_jdbc_batches_count_once(spark):
    store = TablesInMemory(spark)
    assert store.read_batches("tweets").isEmpty()
    rows = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "b")], "tweet_id string, airline string")
    schema = rows.schema
    store.write_batch(rows, "tweets", 0)
    store.write_batch(rows, "tweets", 1)
    store.write_batch(rows, "tweets", 1)
    found = store.read_batches("tweets", schema)
    assert found.groupBy("batch_id", "tweet_id").count().orderBy("batch_id", "tweet_id").collect() == [
        (0, "1", 2),
        (0, "2", 1),
        (1, "1", 2),
        (1, "2", 1),
    ]


def test_jdbc_unfinished_tries_and_repeated_tasks_do_not_count(spark):
    rows = spark.createDataFrame(
        [
            ("x", 0, "first", 0),
            ("x", 0, "second", 0),
            ("x", 0, "second", 0),
            ("y", 0, "second", 1),
            ("z", 1, "third", 0),
        ],
        "tweet_id string, batch_id long, attempt string, row_id long",
    )
    commits = spark.createDataFrame([(0, "second")], COMMIT)
    assert sorted(row["tweet_id"] for row in committed(rows, commits, ["row_id"]).collect()) == ["x", "y"]


def test_jdbc_counts_repeated_in_another_order_count_once(spark):
    store = TablesInMemory(spark)
    store.write_batch(counted(spark, [("a", 1), (None, 2)]), "sentiment_counts_increments", 0)
    written = store._load(dbtable="sentiment_counts_increments")
    again = written.withColumn("row_id", -F.col("row_id"))
    store._write(again, "sentiment_counts_increments", "append")
    found = store.read_batches("sentiment_counts_increments", TABLES["sentiment_counts"])
    assert as_set(found) == {("a", 1, 0), (None, 2, 0)} and found.count() == 2


def test_jdbc_reads(spark):
    store = TablesInMemory(spark)
    assert store.read("sentiment_counts").isEmpty()
    store.replace(counted(spark, [("a", 3), ("a", 3), ("b", 1)]), "sentiment_counts")
    assert as_set(store.read("sentiment_counts")) == {("a", 3), ("b", 1)}
    metric = spark.createDataFrame([("batch", 1, 0.5)], METRIC)
    store.append(metric, "performance_metrics")
    store.append(metric, "performance_metrics")
    assert store.read("performance_metrics").collect() == [("batch", 1, 0.5)] * 2
