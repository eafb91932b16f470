"""Documents to training sequences, in five stages.

Each stage is written to the folder all executors share and read again, so a
lost executor costs a stage at most its own tasks, and a stage judges just
what its predecessor kept.

A null text is an empty one to every stage: it has the score of a document
without words, is equal and near to other empty ones, has no words to mix and
is one token to pack. Texts of any length are taken whole. Of copies and near
copies one row stays, whatever ids repeat or are null, and ties are settled by
id and by hashes of the text and the row. Columns beyond those needed, with
whatever names, stay until the last stage. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chirpline.llm.common import read_table, staging
from chirpline.llm.exact import exact_dedup
from chirpline.llm.mixing import mixed_documents
from chirpline.llm.packing import pack
from chirpline.llm.quality import accepted
from chirpline.llm.simhash import simhash_dedup
from chirpline.session import work_dir
from chirpline.sources import files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the documents at hand."""
    return accepted(docs, read_table(spark, sf_dir, "labels"))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts with near fingerprints."""
    return simhash_dedup(docs, width=4, radius=4)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights: documents repeat by the epoch, and some are left out."""
    return mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, a sequence each."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), longest=2048, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", mixture),
    ("packing", sequences),
]

# The classifier is trained; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has read and staged goes when its result is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        result = work_dir(spark, name.replace(" ", "-"))
        with staging(spark, "stage"):
            stage(spark, docs, sf_dir).write.parquet(result)
        if before:
            files.remove(spark, before)
        docs, before = spark.read.parquet(result), result
    return docs
