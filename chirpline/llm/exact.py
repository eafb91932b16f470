"""Exact deduplication by an extendible-hash index on shared files.

Texts are hashed to 64-bit keys. The index's directory maps the leading bits
of a key to a bucket, and doubles while a bucket holds too many bytes. An
owner task takes whole buckets, that is ranges of keys, and compares the bytes
of the texts there, so that different texts under one key form a chain. All of
it is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import SPACES, one_of_each, staged, text_or_empty, unused

# Buckets that each owner task gets about, so that uneven ones even out.
BUCKETS_PER_TASK = 8
# And the most bytes of a bucket, whatever the input: there are more owner tasks then.
BUCKET_BYTES = 16 << 20
# A directory of up to so many cells is sent to every task.
BROADCAST_CELLS = 1 << 20


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), SPACES, " ")


def _cell(depth: int) -> Column:
    """The key's ``depth`` leading bits."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int, depth: int, deepest: int = 40) -> tuple[DataFrame, int]:
    """Cells of the directory (``cell, bucket``) and its depth.

    ``keys`` has a row per key with its ``n_bytes``, one copy counted. The
    directory doubles until no bucket of several keys is over ``capacity``;
    only the keys of overfull buckets are counted again. Cells whose bucket
    was not split share it: a bucket is named by its first cell.
    """
    load = [F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_keys")]
    full = (F.col("n_bytes") > capacity) & (F.col("n_keys") > 1)
    counted = staged(keys.groupBy(_cell(depth).alias("cell")).agg(*load), "directory")
    while depth < deepest and not counted.filter(full).isEmpty():
        split = counted.filter(full).select("cell")
        parts = (
            keys.withColumn("cell", _cell(depth))
            .join(split, "cell", "left_semi")
            .groupBy(_cell(depth + 1).alias("cell"))
            .agg(*load, F.lit(depth + 1).alias("local_depth"))
        )
        if "local_depth" not in counted.columns:
            counted = counted.withColumn("local_depth", F.lit(depth))
        whole = counted.filter(~full).withColumn("cell", F.col("cell") * 2)
        # Where one of two halves holds no key it needs no row: a look-up never comes there.
        counted = staged(whole.unionByName(parts), "directory")
        depth += 1
    if "local_depth" not in counted.columns:
        counted = counted.withColumn("local_depth", F.lit(depth))
    width = F.pow(F.lit(2.0), F.lit(depth) - F.col("local_depth")).cast("long")
    cells = counted.select(
        F.explode(F.sequence(F.col("cell"), F.col("cell") + width - 1)).alias("cell"), F.col("cell").alias("bucket")
    )
    return staged(cells, "directory"), depth


def exact_groups(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of ASCII white space became
    one space; null counts as empty. Of equal texts the smallest ``doc_id``
    stays. Rows that repeat count in ``group_size``, and rows which share the
    ``doc_id`` that stays are all ``kept``. A null ``doc_id`` is never smaller
    than another; a group of such rows alone has null ``keep_id`` and its rows
    are kept. Other columns are not looked at. An empty table gives no rows.

    ``key_bits`` shortens the keys, to test chains of colliding texts.
    """
    mask = -1 if key_bits >= 64 else ((1 << key_bits) - 1) << (64 - key_bits)
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask
    with_text = docs.select(docs["doc_id"].cast("long").alias("doc_id"), normalised().alias("norm")).withColumn(
        "key", F.xxhash64("norm").bitwiseAND(F.lit(mask))
    )
    entries = staged(
        with_text.select(
            "doc_id",
            "key",
            F.octet_length("norm").cast("long").alias("n_bytes"),
            F.sha2("norm", 256).alias("text_sha256"),
        ),
        "entries",
    )
    per_key = staged(
        entries.groupBy("key").agg(F.count("*").alias("n_rows"), F.max(F.col("n_bytes") + 1).alias("n_bytes")), "keys"
    )
    held = F.col("n_rows") * F.col("n_bytes")
    total, distinct = per_key.agg(F.coalesce(F.sum(held), F.lit(0)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(usual, math.ceil(total / (BUCKETS_PER_TASK * BUCKET_BYTES)))
    capacity = min(BUCKET_BYTES, max(1, total // (tasks * BUCKETS_PER_TASK)))
    depth = max(0, math.ceil(math.log2(max(1, distinct / capacity))))
    cells, depth = directory(per_key, capacity, depth)

    # A key with more copies than a bucket takes has overflow pages. There are
    # no more such keys than buckets, as each holds more bytes than a bucket.
    pages = F.ceil(held / capacity).cast("int")
    overflow = per_key.filter((F.col("n_rows") > 1) & (pages > 1)).select("key", pages.alias("pages"))
    overflow = F.broadcast(overflow) if total // capacity <= BROADCAST_CELLS else overflow
    page = F.when(F.col("pages").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("pages")))
    in_owner = (
        with_text.withColumn("cell", _cell(depth))
        .join(F.broadcast(cells) if 1 << depth <= BROADCAST_CELLS else cells, "cell")
        .join(overflow, "key", "left")
        .select("bucket", page.alias("page"), F.col("pages").isNotNull().alias("paged"), "key", "norm", "doc_id")
        .repartition(*[tasks] * (tasks > usual), "bucket", "page")
        .groupBy("bucket", "page", "paged", "key", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    classes = staged(
        in_owner.select(
            "key", "paged", F.when(F.col("paged"), F.col("norm")).alias("norm"), F.sha2("norm", 256).alias("text_sha256"),
            "keep_id", "group_size",
        ),
        "classes",
    )
    # The classes of overflow pages meet once more, by their bytes.
    merged = (
        classes.filter("paged")
        .groupBy("key", "norm", "text_sha256")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )
    names = ["key", "text_sha256", "keep_id", "group_size"]
    chains = classes.filter("not paged").select(names).unionByName(merged.select(names))
    return (
        entries.drop("n_bytes")
        .join(chains, ["key", "text_sha256"])
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, one of the smallest ``doc_id``, with all its columns.

    A null ``doc_id`` stays only where the whole group has none. Of rows that
    share id and text, the one whose columns have the smallest hash stays.
    """
    sha = unused(docs, "sha")
    marked = docs.withColumn(sha, F.sha2(normalised(), 256))
    kept = exact_groups(docs).filter("kept")
    return one_of_each(marked, sha, staged(kept.groupBy("doc_id", "text_sha256").count(), "kept"))
