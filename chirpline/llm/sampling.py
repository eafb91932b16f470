"""Bounded samples of labelled documents, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import text_or_empty


def fold(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)).cast("int")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, most_bytes: int
) -> tuple[list[tuple[int, bytes]], dict[int, int]]:
    """Labelled texts to learn from, and how many learning rows each class has in all.

    At most ``per_class`` documents for each label 0 and 1, the first by a hash
    of the id, and none of more than ``most_bytes``: their bound is the bound of
    what comes to the driver. Only rows for which ``learn`` holds count. Ids
    that are labelled twice, or repeat among the documents, count once, with the
    greatest of their texts.
    """
    # A label's own columns alone, so that other columns of the same names don't matter.
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(
        learn & F.col("y").isin(0, 1)
    )
    counts = {y: n for y, n in known.groupBy("y").count().collect()}
    order = F.xxhash64("doc_id")
    chosen = None
    for y in sorted(counts):
        first = known.filter(F.col("y") == y).orderBy(order, "doc_id").limit(per_class)
        chosen = first if chosen is None else chosen.unionByName(first)
    if chosen is None:
        return [], counts
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text")).filter(
        F.octet_length("text") <= most_bytes
    )
    # At most two times per_class ids.
    found = small.join(F.broadcast(chosen.groupBy("doc_id").agg(F.min("y").alias("y"))), "doc_id")
    # Each task makes the rows of an id one first, so an id may have any number of them.
    rows = found.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("text").alias("text")).collect()
    return [(row["y"], bytes(row["text"])) for row in sorted(rows, key=lambda x: x["doc_id"])], counts
