"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key whose rate is its quality weight; within
a source, documents in the order of their keys are a weighted sample without
replacement of any length. A source whose target exceeds its size is taken
whole as often as it fits, and only what is left is filled from that order.

The order is never built whole. Keys fall into ranges, the sizes of the ranges
are summed first, and only the range in which a source's budget ends is sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirpline.llm.common import WORD, staged, text_or_empty, unused

# Weights by place of the source in the alphabet, and how often a source may be taken.
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"

ADDED = ("size", "source_size", "target", "taken")
OWN = ("_key", "_range", "_of", "_s", "_epochs", "_end", "_room", "_once")


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def letter_share(column: str = "text") -> Column:
    """A quality weight from 0.05 to 1.05: the share of letters among the characters that are not white space."""
    text = text_or_empty(column)
    others = F.length(F.regexp_replace(text, "[\\p{L}\\x20\\x09-\\x0D]+", ""))
    shown = F.length(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", ""))
    return F.lit(1.05) - F.when(shown > 0, F.try_divide(others, shown)).otherwise(F.lit(1.0))


def exponential_key(weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight with u in (0, 1) from the document's id."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``weight`` and ``target`` to ``source, source_size``.

    All sizes together are shared out by weight. Sources sorted by cap over
    weight are capped one after the other while their share of what is left
    exceeds the cap; the rest share the remainder. One row per source, so the
    windows over the whole table are small.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(place) - 1) % len(weights) + 1)
    rated = sources.withColumn("weight", pick.cast("double")).withColumn("cap", F.col("source_size") * float(most))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    shared = rated.withColumn("capped", left * F.col("weight") > F.col("cap") * weight_left)
    taken_up = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    open_words = F.sum("source_size").over(everything) - taken_up
    open_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    share = F.try_divide(open_words * F.col("weight"), open_weight)
    return shared.withColumn(
        "target", F.when(F.col("capped"), F.col("cap")).otherwise(F.least(share, F.col("cap")))
    ).select("source", "source_size", "weight", "target")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    quality: Column | None = None,
    seed: str = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` plus ``size, source_size, target, taken``.

    ``keep`` names the columns to return beside ``doc_id`` and ``source``, if
    not all. Without ``text`` among them, texts are read once only.

    ``size`` counts words, a null text has none. ``taken`` is the words the mix
    takes of the document: its size for each whole epoch of its source, and
    once more if its key is among the first that fill the rest of the target.
    The document in which the budget ends gives its first words only, so each
    source's words add up to its target, rounded down. A null source is a
    source, the last one. Rows that repeat are documents of their own; equal
    keys go by ``doc_id``, then size. Empty documents, sources without words
    and an empty table take nothing. Columns named as those added are replaced,
    and columns named as a working column (``OWN``) are left out.
    """
    wanted = None if keep is None else {"doc_id", "source", *keep}
    names = [x for x in docs.columns if x.lower() not in ADDED + OWN and (wanted is None or x in wanted)]
    ranges = max(1, math.isqrt(docs.count()))
    key = exponential_key(letter_share() if quality is None else quality, seed)
    keyed = docs.select(*names, word_count().alias("size"), key.alias("_key")).withColumn(
        "_range", F.floor((1 - F.exp(-F.col("_key"))) * ranges).cast("long")
    )
    if "text" not in names:
        keyed = staged(keyed, "keyed")
    summed = staged(keyed.groupBy("source", "_range").agg(F.sum("size").alias("words")), "ranges")
    sources = targets(summed.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    budget = F.floor("target").cast("long")
    sources = sources.withColumn(
        "_epochs", F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0)).cast("long")
    ).withColumn("_rest", budget - F.col("_epochs") * F.col("source_size"))
    upto = Window.partitionBy("_s").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = summed.withColumn("_s", F.struct("source")).withColumn("_after", F.sum("words").over(upto)).drop("_s")
    sources = staged(sources, "sources")
    ends = (
        running.join(sources.select(F.col("source").alias("_of"), "_rest"), F.col("source").eqNullSafe(F.col("_of")))
        .filter((F.col("_rest") > F.col("_after") - F.col("words")) & (F.col("_rest") <= F.col("_after")))
        .select(F.col("_of"), F.col("_range").alias("_end"), (F.col("_rest") - F.col("_after") + F.col("words")).alias("_room"))
    )
    # One row per source; Spark sends it to all tasks if its size allows, and else joins with skew split.
    bounds = staged(
        sources.join(ends, F.col("source").eqNullSafe(F.col("_of")), "left")
        .drop("_of", "_rest", "weight")
        .withColumnRenamed("source", "_of"),
        "bounds",
    )
    met = keyed.join(bounds, F.col("source").eqNullSafe(F.col("_of")))
    at_end = F.coalesce(F.col("_range") == F.col("_end"), F.lit(False))
    sorted_in = (
        Window.partitionBy("_s").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    room_left = F.col("_room") - (F.sum("size").over(sorted_in) - F.col("size"))
    last = (
        met.filter(at_end)
        .withColumn("_s", F.struct("source"))
        .withColumn("_once", F.greatest(F.lit(0), F.least("size", room_left)).cast("long"))
        .drop("_s")
    )
    first = met.filter(~at_end).withColumn(
        "_once", F.when(F.col("_range") < F.col("_end"), F.col("size")).otherwise(0).cast("long")
    )
    return (
        first.unionByName(last)
        .withColumn("taken", F.col("_epochs") * F.col("size") + F.col("_once"))
        .select(*names, "size", "source_size", "target", "taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``.

    A document of which only some words are taken has these words of its text,
    and ``n_chars`` follows where there is such a column.
    """
    renamed = {x: unused(docs, f"own_{x}") for x in docs.columns if x.lower() in (*ADDED, *OWN, "_copy", "_part")}
    columns, docs = docs.columns, docs.withColumnsRenamed(renamed)
    copies = F.ceil(F.try_divide(F.col("taken"), F.col("size"))).cast("int")
    mixed = mix(docs, **options).filter("taken > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    words = F.least(F.col("size"), F.col("taken") - (F.col("_copy") - 1) * F.col("size"))
    cut_at = "(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])"  # after each word
    start = F.array_join(F.slice(F.split("text", cut_at), F.lit(1), words.cast("int")), "")
    mixed = mixed.withColumn("_part", words < F.col("size")).withColumn(
        "text", F.when(F.col("_part"), start).otherwise(F.col("text"))
    )
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        mixed = mixed.withColumn("n_chars", F.when(F.col("_part"), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return mixed.select(docs.columns).toDF(*columns)
