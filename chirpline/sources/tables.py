"""Result tables, in Parquet folders or in a database over JDBC."""

from __future__ import annotations

import copy
import os
import threading
import uuid
import warnings
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from typing import Protocol

from pyspark import InheritableThread
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chirpline.operators.counts import add_up, newest
from chirpline.operators.ordering import top
from chirpline.schema import ENDINGS, TABLES, keys_of
from chirpline.sources import files
from chirpline.sources.countlog import BUCKETS, FOLD_AFTER, CountLog
from chirpline.sources.manifest import Manifest

BATCH = StructField("batch_id", LongType())

# Batches of a table of rows that are merged at a time.
MERGE_AFTER = 64


def with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, BATCH])


class Tables(Protocol):
    """What both kinds of tables can do."""

    def replace(self, rows: DataFrame, table: str) -> None:
        """Make the given rows the whole table."""

    def append(self, rows: DataFrame, table: str) -> None:
        """Add rows."""

    def write_batch(self, rows: DataFrame, table: str, batch_id: int) -> None:
        """Add the rows of a micro-batch, once, however often it is tried."""

    def write_batches(self, parts: dict[str, DataFrame], batch_id: int) -> None:
        """Add what one micro-batch gives to several tables."""

    def together(self) -> AbstractContextManager[Tables]:
        """Tables whose ``replace`` is seen by others at the end of the block, all at once; within it, at once."""

    def snapshot(self) -> Tables:
        """The tables as they are now, whatever is written from now on."""

    def settle(self) -> None:
        """Wait for what is done in the background."""

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        """The rows; an empty frame if the table was never written."""

    def read_batches(self, table: str, schema: StructType | None = None) -> DataFrame:
        """The rows of a table filled by ``write_batch``, with ``batch_id``."""

    def read_increments(self, table: str) -> DataFrame:
        """The counts that batches have added to a table of counts, to be added up by key."""

    def exists(self, table: str) -> bool:
        """Whether the table was ever written."""

    def read_top(self, table: str, k: int, stored_as: str = "current") -> DataFrame:
        """The ``k`` largest counts, whichever way a stream has stored them."""

    def read_counts(self, table: str, values: list[str], stored_as: str = "current") -> DataFrame:
        """The counts of some values of the first key."""


def current_counts(store: Tables, table: str, stored_as: str = "current") -> DataFrame:
    """Running counts as last stored, whichever way they are stored.

    Of snapshots the last one has all. Counts by sentiment have no increments
    of their own: they are sums of those by airline and sentiment.
    """
    if stored_as == "current":
        return store.read(table)
    if stored_as == "increments" and table == "sentiment_counts":
        return add_up(current_counts(store, "airline_sentiment", stored_as), *keys_of(table))
    if stored_as == "increments":
        return fold(store.read_increments(table), table, stored_as)
    rows = store.read_batches(table + ENDINGS[stored_as], TABLES[table])
    if stored_as == "history":
        last = rows.agg(F.max(BATCH.name)).first()[0]  # of the folders' names, or an indexed column
        rows = rows if last is None else rows.where(F.col(BATCH.name) == last)
    return fold(rows, table, stored_as)


def fold(rows: DataFrame, table: str, stored_as: str) -> DataFrame:
    """Current counts out of what several batches have stored."""
    return add_up(rows, *keys_of(table)) if stored_as == "increments" else newest(rows, *keys_of(table))


class ParquetTables:
    """Tables as folders below ``root``, which all executors must reach.

    A manifest names what counts: the folder of each table that was replaced,
    the last batch of each that is filled by several, and the state of each
    log of counts. ``replace`` writes a new folder and then has the manifest
    name it, so a reader finds the old table or the new one. The one before
    stays until the next ``replace``, for readers that have begun.

    Increments of counts are kept as a log (``CountLog``) which is folded in
    the background once it has ``fold_after`` deltas; 0 leaves that to the
    caller. Other tables that are filled by ``write_batches`` gain a folder per
    batch; every ``merge_after`` of them are merged in the background too.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        fold_after: int = FOLD_AFTER,
        buckets: int = BUCKETS,
        merge_after: int = MERGE_AFTER,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest = Manifest(spark, self.root)
        self.fold_after = fold_after
        self.merge_after = merge_after
        self.buckets = buckets
        self._pinned: dict | None = None
        self._replaced: dict[str, str] | None = None
        self._folds: dict[str, threading.Thread] = {}
        self._failed: list[str] = []

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def state(self) -> dict:
        """What the manifest says, or said when the snapshot was taken."""
        return self.manifest.load() if self._pinned is None else self._pinned

    def snapshot(self) -> ParquetTables:
        """All tables as of one moment. Read it before tables are replaced, or logs folded, twice more."""
        pinned = copy.copy(self)
        pinned._pinned = self.state()
        return pinned

    @contextmanager
    def together(self) -> Iterator[ParquetTables]:
        inside = self.snapshot()
        inside._replaced = {}
        yield inside
        self._name(inside._replaced)

    def location(self, table: str) -> str:
        return "/".join([self.path(table), *self.state().get("current", {}).get(table, [])[:1]])

    def replace(self, rows: DataFrame, table: str) -> None:
        new = f"version-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path(table)}/{new}")
        if self._replaced is None:
            self._name({table: new})
        else:
            self._replaced[table] = new
            self._pinned.setdefault("current", {})[table] = [new]

    def _name(self, replaced: dict[str, str]) -> None:
        old: list[str] = []

        def name(state: dict) -> None:
            old.clear()
            current = state.setdefault("current", {})
            for table, new in replaced.items():
                before = current.get(table, [])
                old.extend(f"{self.path(table)}/{x}" for x in before[1:])
                current[table] = [new, *before[:1]]

        self.manifest.change(name)
        for path in old:
            files.remove(self.spark, path)

    def append(self, rows: DataFrame, table: str) -> None:
        rows.write.mode("append").parquet(self.location(table))

    def write_batch(self, rows: DataFrame, table: str, batch_id: int) -> None:
        """A batch owns one folder of the table, which each try overwrites, or adds one delta to a log."""
        if table.endswith(ENDINGS["increments"]):
            self.write_batches({table: rows}, batch_id)
        else:
            rows.write.mode("overwrite").parquet(f"{self.path(table)}/{BATCH.name}={batch_id}")

    def write_batches(self, parts: dict[str, DataFrame], batch_id: int) -> None:
        """All parts are seen from one change of the manifest on, so readers find the batch in all tables or in none."""
        state = self.manifest.load()
        logs = {table: self.log(table) for table in parts if table.endswith(ENDINGS["increments"])}
        deltas = {}
        for table, rows in parts.items():
            if table in logs:
                deltas[table] = logs[table].write_delta(rows, batch_id, state)
            else:
                self.write_batch(rows, table, batch_id)

        def name(state: dict) -> None:
            for table in parts:
                if table not in logs:
                    last = state.setdefault("last", {})
                    last[table] = max(batch_id, last.get(table, batch_id))
                elif deltas[table]:
                    logs[table].name_delta(state, batch_id, deltas[table])

        state = self.manifest.change(name)
        for table, log in logs.items():
            if self.fold_after and log.is_due(state, self.fold_after):
                self._beside(table, log.fold)
        for table in parts.keys() - logs.keys():
            if self.merge_after and batch_id - self._merged(state, table)["through"] > self.merge_after:
                self._beside(table, lambda table=table: self.merge_batches(table))

    def log(self, table: str) -> CountLog:
        schema = TABLES[table.removesuffix(ENDINGS["increments"])]
        return CountLog(self.spark, self.manifest, self.path(table), table, schema, self.buckets)

    def _merged(self, state: dict, table: str) -> dict:
        """Which batches of a table were merged: all to ``through``, in ``folders``; ``stale`` folders go with the next merge."""
        none = {"through": -2, "folders": [], "stale": []}
        return state.get("merged", {}).get(table, none)

    def merge_batches(self, table: str) -> bool:
        """Make the batches that are there, but for the last, one folder of files of Spark's usual size.

        The last batch stays by itself, as a stream repeats it if it was
        stopped before marking it done. Batches may be added meanwhile. Until
        the manifest names the new folder nothing has changed, so a merge that
        ends midway leaves a folder that nobody reads. What was merged is
        removed by the next merge, for readers that have begun. Returns whether
        it has merged any.
        """
        state = self.manifest.load()
        merged, last = self._merged(state, table), state.get("last", {}).get(table, -1)
        batches = [n for n in self._batches(table) if merged["through"] < n < last]
        if not batches:
            return False
        folder = f"merged-{uuid.uuid4().hex}"
        rows = self._batch_rows(table, TABLES[table], batches)
        # Files as large as the shuffle's partitions are meant to be, whatever the number of batches.
        rows.hint("rebalance").write.parquet(f"{self.path(table)}/{folder}")

        def name(state: dict) -> bool | None:
            now = self._merged(state, table)
            if now["through"] != merged["through"]:
                return False  # another merge was first
            stale = [f"{BATCH.name}={n}" for n in batches]
            named = {"through": batches[-1], "folders": [*now["folders"], folder], "stale": stale}
            state.setdefault("merged", {})[table] = named
            return None

        done = folder in self._merged(self.manifest.change(name), table)["folders"]
        for old in merged["stale"] if done else [folder]:
            files.remove(self.spark, f"{self.path(table)}/{old}")
        return done

    def _batches(self, table: str) -> list[int]:
        prefix = f"{BATCH.name}="
        names = files.names(self.spark, self.path(table))
        return sorted(int(x.removeprefix(prefix)) for x in names if x.startswith(prefix))

    def _batch_rows(self, table: str, schema: StructType, batches: list[int]) -> DataFrame:
        """Rows of some batches, which have a folder each."""
        if not batches:
            return self.spark.createDataFrame([], with_batch(schema))
        paths = [f"{self.path(table)}/{BATCH.name}={n}" for n in batches]
        reader = self.spark.read.schema(with_batch(schema)).option("basePath", self.path(table))
        return reader.parquet(*paths).select(*schema.names, BATCH.name)

    def _beside(self, table: str, work: Callable[[], bool]) -> None:
        """Work in a thread of its own, so that batches go on; one at a time for a table."""
        running = self._folds.get(table)
        if running and running.is_alive():
            return

        def run() -> None:
            try:
                work()
            except Exception as error:  # nothing has changed, and the next batch tries again
                self._failed.append(f"{table} was not folded or merged: {error}"[:500])

        self._folds[table] = InheritableThread(target=run, daemon=True)
        self._folds[table].start()

    def settle(self) -> None:
        """Wait for folds and merges that are running, and say which failed."""
        for thread in self._folds.values():
            thread.join()
        while self._failed:
            warnings.warn(self._failed.pop(), stacklevel=2)

    def read_increments(self, table: str) -> DataFrame:
        return self.log(table + ENDINGS["increments"]).read(self.state())

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        schema = schema or TABLES[table]
        if table in self.state().get("last", {}):
            return self.read_batches(table, schema).select(*schema.names)
        return self._read_folder(table, schema)

    def _read_folder(self, table: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.location(table)).select(*schema.names)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read_batches(self, table: str, schema: StructType | None = None) -> DataFrame:
        """Of a table filled by ``write_batches``, the batches that the manifest knows, merged or not."""
        schema, state = schema or TABLES[table], self.state()
        last = state.get("last", {}).get(table)
        if last is None:
            return self._read_folder(table, with_batch(schema))
        merged = self._merged(state, table)
        rows = self._batch_rows(table, schema, [n for n in self._batches(table) if merged["through"] < n <= last])
        folders = [f"{self.path(table)}/{x}" for x in merged["folders"]]
        if folders:
            rows = rows.unionByName(self.spark.read.schema(with_batch(schema)).parquet(*folders))
        return rows

    def exists(self, table: str) -> bool:
        return files.exists(self.spark, self.path(table))

    def is_empty(self) -> bool:
        """Whether no table was ever written."""
        return files.is_empty(self.spark, self.root)

    def read_top(self, table: str, k: int, stored_as: str = "current") -> DataFrame:
        return top(current_counts(self, table, stored_as), k)

    def read_counts(self, table: str, values: list[str], stored_as: str = "current") -> DataFrame:
        return current_counts(self, table, stored_as).where(F.col(keys_of(table)[0]).isin(values))


class JdbcTables:
    """Tables in a database. The password comes from the environment.

    A JDBC write has no upsert, and a task that is run again after its commit
    was lost adds its rows twice. Count tables are therefore read as the
    largest count per key. Batches carry the try that wrote them; a try counts
    once its entry in the commit table exists, and of several only one. Within
    a try a row is told from its repeat by its keys or, where it has none, by
    its number, which is the same each time a task reads its input.

    ``connections`` bounds how many tasks write to the database at a time, and
    read batches from it. Rows are dealt anew to that many tasks before they
    are written, so what makes them keeps its own width. ``read`` takes a
    plain table over several connections if ``parts`` is given; ``hash_of``
    says how the database makes a whole number out of a text.

    Statements are standard SQL with double-quoted names and need
    ``information_schema``, as PostgreSQL has it. A table may be named with
    its schema. ``replace`` needs transactions: readers find the old rows until
    the new ones are all there.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        *,
        driver: str = "org.postgresql.Driver",
        user: str = "postgres",
        password_variable: str = "JDBC_PASSWORD",
        connections: int = 16,
        write_options: dict[str, str] | None = None,
        hash_of: str = "hashtext({})",
    ):
        self.hash_of = hash_of
        self.spark = spark
        self.url = url
        self.driver = driver
        self.user = user
        self.password_variable = password_variable
        self.connections = connections
        self.write_options = write_options or {}
        self._staged: dict[str, tuple[str, StructType]] | None = None
        self._until: int | None = None

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": os.environ.get(self.password_variable, ""),
        }

    def _write(self, rows: DataFrame, table: str, mode: str) -> None:
        (
            rows.repartition(self.connections)
            .write.format("jdbc")
            .options(**self.options(), **self.write_options)
            .option("dbtable", table)
            .option("numPartitions", self.connections)
            .option("truncate", "true")
            .mode(mode)
            .save()
        )

    def replace(self, rows: DataFrame, table: str) -> None:
        """Write the rows to a table beside it, and have the database move them over in one transaction."""
        with self.together() as tables:
            tables._stage(rows, table)

    def _stage(self, rows: DataFrame, table: str) -> None:
        beside = f"{table}_{uuid.uuid4().hex[:12]}"
        self._staged[table] = beside, rows.schema
        self._write(rows, beside, "overwrite")
        if not self.exists(table):
            self._write(rows.limit(0), table, "overwrite")

    @contextmanager
    def together(self) -> Iterator[JdbcTables]:
        if self._staged is not None:  # part of a transaction already
            yield self
            return
        inside = copy.copy(self)
        inside._staged = {}
        try:
            yield inside
            if inside._staged:
                self._transact([x for table, staged in inside._staged.items() for x in move_statements(table, *staged)])
        finally:
            if inside._staged:
                self._transact([f"DROP TABLE IF EXISTS {beside}" for beside, _ in inside._staged.values()])

    def _connect(self):
        """A connection of the driver's own, for statements that belong together."""
        jvm = self.spark._jvm
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.driver)
        properties = jvm.java.util.Properties()
        for name in ("user", "password"):
            properties.setProperty(name, self.options()[name])
        return jvm.java.sql.DriverManager.getConnection(self.url, properties)

    def _transact(self, statements: list[str]) -> None:
        """Run all statements or, should one fail, none."""
        connection = self._connect()
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            try:
                for text in statements:
                    statement.executeUpdate(text)
                connection.commit()
            except Exception:
                connection.rollback()
                raise
            finally:
                statement.close()
        finally:
            connection.close()

    def snapshot(self) -> JdbcTables:
        """Of increments, the batches to the last one that all their tables have finished.

        Other tables are read as they are when asked for: a database keeps no
        state of its tables beyond a transaction.
        """
        pinned = copy.copy(self)
        lasts = []
        for table in ("hashtags", "airline_sentiment"):
            commits = f"{table}{ENDINGS['increments']}_commits"
            if self.exists(commits):
                lasts.append(self.query(f"SELECT MAX(batch_id) AS last FROM {commits}").first()["last"])
        if len(lasts) == 2 and None not in lasts:
            pinned._until = min(lasts)
        return pinned

    def append(self, rows: DataFrame, table: str) -> None:
        self._write(rows, table, "append")

    def write_batch(self, rows: DataFrame, table: str, batch_id: int) -> None:
        attempt = uuid.uuid4().hex
        numbered = (
            rows.withColumn(BATCH.name, F.lit(batch_id).cast("long"))
            .withColumn("attempt", F.lit(attempt))
            .withColumn("row_id", F.monotonically_increasing_id())
        )
        self._write(numbered, table, "append")
        done = self.spark.createDataFrame([(batch_id, attempt)], COMMIT)
        self._write(done, f"{table}_commits", "append")

    def write_batches(self, parts: dict[str, DataFrame], batch_id: int) -> None:
        for table, rows in parts.items():
            self.write_batch(rows, table, batch_id)

    def settle(self) -> None:
        """Nothing is done in the background."""

    def read_increments(self, table: str) -> DataFrame:
        return self.read_batches(table + ENDINGS["increments"], TABLES[table])

    def _load(self, **options: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options(), **options).load()

    def query(self, statement: str) -> DataFrame:
        """Result of a statement that the database runs."""
        return self._load(query=statement)

    def exists(self, table: str) -> bool:
        return not self.query(exists_query(table)).isEmpty()

    def _load_parts(self, table: str, predicates: list[str]) -> DataFrame:
        """A table over as many connections, each of which takes the rows of one predicate."""
        options = self.options()
        return self.spark.read.jdbc(options.pop("url"), table, predicates=predicates, properties=options)

    def read(
        self, table: str, schema: StructType | None = None, *, parts: int | None = None, **partitioning: str
    ) -> DataFrame:
        """Rows of a table; ``partitioning`` takes Spark's options
        ``partitionColumn``, ``lowerBound``, ``upperBound`` and
        ``numPartitions`` to read a large one over several connections, and
        ``parts`` reads one without a number to go by, in so many parts by the
        hash of its keys, or of its first column. Of a table filled by batches,
        only those that were finished, each once."""
        schema = schema or TABLES[table]
        table = (self._staged or {}).get(table, (table,))[0]
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        if self.exists(f"{table}_commits"):
            return self.read_batches(table, schema, **partitioning).select(*schema.names)
        keys = [name for name in schema.names if name != "count"]
        if parts and parts > 1:
            by = keys if "count" in schema.names else schema.names[:1]
            rows = self._load_parts(table, hash_predicates(by, parts, self.hash_of))
        else:
            rows = self._load(dbtable=table, **partitioning)
        rows = rows.select(*schema.names)
        return newest(rows, *keys) if "count" in schema.names else rows

    def read_batches(self, table: str, schema: StructType | None = None, **partitioning: str) -> DataFrame:
        """Finished batches, read over several connections by their number."""
        schema = with_batch(schema or TABLES[table])
        if not self.exists(f"{table}_commits"):
            return self.spark.createDataFrame([], schema)
        commits = self._load(dbtable=f"{table}_commits")
        if self._until is not None and table.endswith(ENDINGS["increments"]):
            commits = commits.where(F.col(BATCH.name) <= self._until)
        rows = self._load(dbtable=table, **(partitioning or self._by_batch(commits)))
        identity = [name for name in schema.names if name != "count"] if "count" in schema.names else ["row_id"]
        return committed(rows, commits, identity).select(*schema.names)

    def _by_batch(self, commits: DataFrame) -> dict[str, str]:
        first, last = commits.agg(F.min(BATCH.name), F.max(BATCH.name)).first()
        if first is None or first == last:
            return {}
        return {
            "partitionColumn": BATCH.name,
            "lowerBound": str(first),
            "upperBound": str(last + 1),
            "numPartitions": str(min(self.connections, last - first + 1)),
        }

    def read_top(self, table: str, k: int, stored_as: str = "current") -> DataFrame:
        """The database adds up, sorts and cuts, so only ``k`` rows are read."""
        stored = table + ENDINGS[stored_as]
        if not self.exists(stored):
            return self.spark.createDataFrame([], TABLES[table])
        return self.query(top_query(stored, keys_of(table), k, stored_as, self._until))

    def read_counts(self, table: str, values: list[str], stored_as: str = "current") -> DataFrame:
        stored = table + ENDINGS[stored_as]
        if not self.exists(stored) or not values:
            return self.spark.createDataFrame([], TABLES[table])
        return self.query(counts_query(stored, keys_of(table), stored_as, values, self._until))


COMMIT = StructType([BATCH, StructField("attempt", StringType())])


def committed(rows: DataFrame, commits: DataFrame, identity: list[str]) -> DataFrame:
    """Rows of one finished try per batch, each row once."""
    chosen = commits.groupBy(BATCH.name).agg(F.min("attempt").alias("attempt"))
    tried = rows.join(chosen, [BATCH.name, "attempt"], "left_semi")
    return tried.dropDuplicates(list(dict.fromkeys([BATCH.name, *identity])))


def hash_predicates(columns: list[str], parts: int, hash_of: str) -> list[str]:
    """Conditions of which each row meets exactly one, whatever it holds: a null counts as an empty text."""
    text = " || chr(31) || ".join(f"""COALESCE(CAST("{name}" AS VARCHAR), '')""" for name in columns)
    number = hash_of.format(text)
    # The remainder of a negative number may be negative.
    return [f"MOD(MOD({number}, {parts}) + {parts}, {parts}) = {part}" for part in range(parts)]


def exists_query(table: str) -> str:
    schema, _, name = table.rpartition(".")
    where = f" AND table_schema = '{schema}'" if schema else ""
    return f"SELECT 1 AS found FROM information_schema.tables WHERE table_name = '{name}'{where}"


def move_statements(table: str, beside: str, schema: StructType) -> list[str]:
    """Make the rows of the table ``beside`` the rows of a table, which keeps its definition.

    To be run in one transaction. A count that a repeated task has written
    twice is moved once.
    """
    named = ", ".join(f'"{name}"' for name in schema.names)
    rows = f"SELECT {named} FROM {beside}"
    if "count" in schema.names:
        keys = ", ".join(f'"{name}"' for name in schema.names if name != "count")
        named = f'{keys}, "count"'
        rows = f'SELECT {keys}, MAX("count") FROM {beside} GROUP BY {keys}'
    return [f"DELETE FROM {table}", f"INSERT INTO {table} ({named}) {rows}"]


def counts_query(
    table: str, keys: list[str], stored_as: str = "current", values: list[str] | None = None, until: int | None = None
) -> str:
    """Current counts, for some values of the first key if given, and of increments to batch ``until``.

    Of a table filled by batches, rows of the chosen try of each finished batch
    count, once each. The filter reaches the table before anything is added up.
    """
    named = ", ".join(f'"{key}"' for key in keys)
    only = ""
    if values is not None:
        listed = ", ".join("'" + value.replace("'", "''") + "'" for value in values)
        only = f'"{keys[0]}" IN ({listed})'
    if stored_as == "current":
        rows, where = table, f" WHERE {only}" if only else ""
    else:
        to = f" WHERE batch_id <= {until}" if until is not None and stored_as == "increments" else ""
        chosen = f"(SELECT batch_id, MIN(attempt) AS attempt FROM {table}_commits{to} GROUP BY batch_id)"
        rows = (
            f'(SELECT DISTINCT t.batch_id, {", ".join(f"""t."{key}\"""" for key in keys)}, t."count" '
            f"FROM {table} t JOIN {chosen} c ON t.batch_id = c.batch_id AND t.attempt = c.attempt"
            + (f" WHERE t.{only}" if only else "")
            + ") stored"
        )
        where = ""
    # A sum of whole numbers may have another type, so it is cast back.
    total = 'CAST(SUM("count") AS BIGINT)' if stored_as == "increments" else 'MAX("count")'
    return f'SELECT {named}, {total} AS "count" FROM {rows}{where} GROUP BY {named}'


def top_query(table: str, keys: list[str], k: int, stored_as: str = "current", until: int | None = None) -> str:
    named = ", ".join(f'"{key}"' for key in keys)
    return f'{counts_query(table, keys, stored_as, until=until)} ORDER BY "count" DESC, {named} LIMIT {k}'
