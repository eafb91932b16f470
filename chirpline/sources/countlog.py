"""Counts that grow by batches: a base, and what later batches add to it.

A batch writes only the counts it adds, as a delta. Keys fall into buckets by
their hash, and the base has a folder for each bucket; folding adds the deltas
to the base of the buckets they touch and leaves the others as they are.
Readers take the base and the deltas that are not in it yet, as one record of
the manifest names them, so they see whole batches only, before a fold or
after it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from chirpline.operators.counts import add_up
from chirpline.sources import files
from chirpline.sources.manifest import Manifest

# Buckets of a new log. They bound what a fold must rewrite for a few keys, and the folders a reader lists.
BUCKETS = 32
# A fold is due at so many deltas.
FOLD_AFTER = 8

BUCKET = StructField("bucket", IntegerType())
ADDED_BY = StructField("added_by", LongType())


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class CountLog:
    """The log of one table of counts below ``path``.

    Its part of the manifest: ``buckets``; ``base``, the folder of each bucket
    that has one; ``through``, the last batch in the base of each bucket;
    ``deltas``, the batch and folder of each that some bucket still needs;
    ``last``, the last batch of all; ``folding``, the base that is being made;
    and ``stale``, folders that no new reader needs, which go with the next fold.
    """

    def __init__(self, spark: SparkSession, manifest: Manifest, path: str, table: str, schema: StructType, buckets: int = BUCKETS):
        self.spark = spark
        self.manifest = manifest
        self.path = path
        self.table = table
        self.schema = schema
        self.keys = [name for name in schema.names if name != "count"]
        self.buckets = buckets

    def of(self, state: dict) -> dict | None:
        return state.get("logs", {}).get(self.table)

    def _empty(self) -> dict:
        return {
            "buckets": self.buckets, "base": {}, "through": [-1] * self.buckets,
            "deltas": [], "last": -1, "folding": None, "stale": [],
        }

    def write_delta(self, rows: DataFrame, batch_id: int, state: dict) -> str | None:
        """Write what a batch adds; nothing is to be seen of it yet. ``None`` if the batch is there already."""
        log = self.of(state) or self._empty()
        if batch_id == log["last"]:
            return None
        if batch_id < log["last"]:
            raise ValueError(f"{self.path} holds batches to {log['last']}; batch {batch_id} is of another run")
        name = f"delta-{batch_id}-{uuid.uuid4().hex}"
        marked = rows.withColumn(BUCKET.name, bucket_of(self.keys, log["buckets"]))
        marked.withColumn(ADDED_BY.name, F.lit(batch_id).cast("long")).write.parquet(f"{self.path}/{name}")
        return name

    def name_delta(self, state: dict, batch_id: int, name: str) -> None:
        """Have the record name a delta that was written, unless it names one of the batch."""
        log = state.setdefault("logs", {}).setdefault(self.table, self._empty())
        if batch_id > log["last"]:
            log["deltas"].append([batch_id, name])
            log["last"] = batch_id

    def name_base(self, state: dict, name: str, last: int) -> None:
        """Have the record begin with a base that holds all batches to ``last``."""
        log = self._empty()
        log |= {"base": {str(b): name for b in range(self.buckets)}, "through": [last] * self.buckets, "last": last}
        state.setdefault("logs", {})[self.table] = log

    def write_base(self, rows: DataFrame, buckets: int, name: str) -> None:
        """Write counts by bucket, added up."""
        summed = add_up(rows.withColumn(BUCKET.name, bucket_of(self.keys, buckets)), BUCKET.name, *self.keys)
        # Each task has few buckets, so there are not many small files.
        summed.withColumn("part", F.col(BUCKET.name)).repartition(BUCKET.name).write.partitionBy("part").parquet(f"{self.path}/{name}")

    def _parquet(self, paths: list[str], *more: StructField) -> DataFrame:
        schema = StructType([*self.schema.fields, BUCKET, *more])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _base(self, log: dict, buckets: list[int] | None = None) -> DataFrame:
        """The base of some buckets, or of all. A bucket into which no key falls has no folder."""
        chosen = log["base"] if buckets is None else {str(b): log["base"][str(b)] for b in buckets if str(b) in log["base"]}
        parts = {folder: files.names(self.spark, f"{self.path}/{folder}") for folder in set(chosen.values())}
        return self._parquet([f"{self.path}/{x}/part={b}" for b, x in chosen.items() if f"part={b}" in parts[x]])

    def _deltas(self, log: dict) -> DataFrame:
        """Rows of deltas that are not in the base of their bucket."""
        rows = self._parquet([f"{self.path}/{name}" for _, name in log["deltas"]], ADDED_BY)
        through = log["through"]
        if min(through) == max(through):
            return rows.where(F.col(ADDED_BY.name) > through[0])
        known = F.array(*[F.lit(x).cast("long") for x in through])
        return rows.where(F.col(ADDED_BY.name) > F.get(known, F.col(BUCKET.name)))

    def read(self, state: dict) -> DataFrame:
        """All counts as of one record, several per key: the base, and what came after."""
        log = self.of(state)
        if not log:
            return self.spark.createDataFrame([], self.schema)
        return self._base(log).select(*self.schema.names).unionByName(self._deltas(log).select(*self.schema.names))

    def is_due(self, state: dict, after: int = FOLD_AFTER) -> bool:
        log = self.of(state)
        return bool(log) and len(log["deltas"]) >= after

    def fold(self, most: int | None = None) -> bool:
        """Add the deltas to the base, in ``most`` buckets at a time if given: those to which most rows were added.

        Batches may be added meanwhile. Until the record names the new base
        nothing has changed, so a fold that ends midway leaves files that
        nobody reads, and the next one removes them. Of two folds the one that
        began last counts. Returns whether it has changed anything.
        """
        name = f"base-{uuid.uuid4().hex}"

        def announce(state: dict) -> bool | None:
            log = self.of(state)
            if not log or not log["deltas"]:
                return False
            log["folding"] = name
            return None

        log = self.of(self.manifest.change(announce))
        if not log or log["folding"] != name:
            return False
        self._remove_unnamed(log)
        to = max(batch for batch, _ in log["deltas"])
        pending = self._deltas(log)
        sizes = {row[BUCKET.name]: row["count"] for row in pending.groupBy(BUCKET.name).count().collect()}  # a row per bucket
        touched = sorted(sorted(sizes, key=sizes.get, reverse=True)[:most])
        if touched:
            rows = pending.where(F.col(BUCKET.name).isin(touched)).select(*self.schema.names)
            self.write_base(rows.unionByName(self._base(log, touched).select(*self.schema.names)), log["buckets"], name)

        def exchange(state: dict) -> bool | None:
            now = self.of(state)
            if now["folding"] != name:
                return False
            old = [f"{now['base'][str(b)]}/part={b}" for b in touched if str(b) in now["base"]]
            now["base"] |= {str(b): name for b in touched}
            now["through"] = [x if b in sizes and b not in touched else max(x, to) for b, x in enumerate(now["through"])]
            needed = min(now["through"])
            old += [folder for batch, folder in now["deltas"] if batch <= needed]
            now["deltas"] = [x for x in now["deltas"] if x[0] > needed]
            now["stale"], now["folding"] = old, None
            return None

        now = self.of(self.manifest.change(exchange))
        done = name in now["base"].values() or (not touched and now["folding"] is None)
        if done:
            for folder in log["stale"]:
                files.remove(self.spark, f"{self.path}/{folder}")
        return done

    def _remove_unnamed(self, log: dict) -> None:
        """Remove what the record will never name: bases of broken folds, and deltas of tries that were repeated."""
        named = {*log["base"].values(), *(x.split("/")[0] for x in log["stale"]), *(x for _, x in log["deltas"]), log["folding"]}
        for folder in files.names(self.spark, self.path):
            kind, _, rest = folder.partition("-")
            over = kind == "base" or (kind == "delta" and int(rest.split("-")[0]) <= log["last"])
            if over and folder not in named:
                files.remove(self.spark, f"{self.path}/{folder}")
