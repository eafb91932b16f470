"""How the wording of each source differs from other sources and from its language.

Terms are counted and compared as 64-bit digests, as are languages and
sources; strings come back only for the rows that are returned. The smallest
and the largest string of each digest tell whether it stands for more than
one term, and such digests are split. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirpline.llm.common import blocks, staged, text_or_empty, texts_of

# The scale of shares, and how many terms of a group are listed.
SCALE = 1_000_000_000
TERMS_LISTED = 200
LEAST_DOCUMENTS = 3

# Bytes that are part of a term, lower-cased; all others separate.
TERM_BYTES = bytes(x if x >= 0x80 or chr(x).isalpha() else 0x20 for x in range(256)).lower()

# What a task holds before it hands its counts on.
HELD_TERMS = 700_000
HELD_BYTES = 32 << 20
# Pairs of places of terms that are worked out at a time.
PAIRS_AT_ONCE = 1 << 20
# How often other digests of languages and sources are tried, should two have one.
TRIES = 8

# A term of a language, of which ``split`` tells apart those with one digest.
TERM = ["digest", "split"]


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters A to Z, lower-cased, and of characters beyond ASCII."""
    return text.translate(TERM_BYTES).split()


def _partial_counts(rows: DataFrame, digest_bits: int, all_terms: bool = False) -> DataFrame:
    """``lid, gid, digest, term, n, n_docs``: occurrences and documents, summed up by what a task holds at a time.

    Of the rows that a task hands on at a time only the first one of a term
    has its string, unless ``all_terms`` have.
    """
    mask = (1 << digest_bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[Counter, Counter]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            named: dict[int, set[bytes]] = {}
            digest = xxhash.xxh3_64_intdigest
            for (lid, gid), (n, n_docs) in held.items():
                seen, seed, size = named.setdefault(lid, set()), lid & 0xFFFFFFFFFFFFFFFF, len(n)
                digests = np.array([digest(x, seed) for x in n], dtype=np.uint64) & np.uint64(mask)
                terms = list(n) if all_terms else [None if x in seen else x for x in n]
                seen.update(n)
                columns = [
                    pa.array(np.full(size, lid)),
                    pa.array(np.full(size, gid)),
                    pa.array(digests.view(np.int64)),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(np.fromiter(n.values(), dtype=np.int64, count=size)),
                    pa.array(np.fromiter(map(n_docs.__getitem__, n), dtype=np.int64, count=size)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lid", "gid", "digest", "term", "n", "n_docs"])
            held.clear()

        for batch in batches:
            for block in blocks(batch, "text"):
                keys = zip(block.column("lid").to_pylist(), block.column("gid").to_pylist(), strict=True)
                for key, text in zip(keys, texts_of(block, "text"), strict=True):
                    terms = terms_of(text)
                    if terms:
                        n, n_docs = held.setdefault(key, (Counter(), Counter()))
                        n.update(terms)
                        n_docs.update(set(terms))
                size += block.column("text").nbytes
                if size > HELD_BYTES or sum(len(x[0]) for x in held.values()) > HELD_TERMS:
                    yield from flush()
                    size = 0
        yield from flush()

    return rows.mapInArrow(run, "lid long, gid long, digest long, term string, n long, n_docs long")


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts with digests of their language and group, and all groups ``lid, gid, lang, source``."""
    blank = [F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("lang", "source")]
    rows = docs.select(*blank, text_or_empty().alias("text"))
    for seed in range(TRIES):
        known = rows.withColumn("lid", F.xxhash64(F.lit(seed), "lang")).withColumn("gid", F.xxhash64("lid", "source"))
        groups = staged(known.select("lid", "gid", "lang", "source").distinct(), "groups")
        twice = groups.groupBy("gid").count().filter("count > 1").select("gid")
        if twice.unionByName(groups.groupBy("lid").agg(F.countDistinct("lang").alias("n")).filter("n > 1").select(F.col("lid").alias("gid"))).isEmpty():
            return known.select("lid", "gid", "text"), groups
    raise ValueError("languages or sources cannot be told apart by their digests")


def _split(rows: DataFrame, partial: DataFrame, strings: DataFrame, digest_bits: int) -> tuple[DataFrame, DataFrame]:
    """The counts with ``split`` in place of ``term``, and ``digest, split, term`` of all terms.

    A digest whose smallest and largest string are one stands for one term,
    and its split is 0. The terms of any other are numbered; for these the
    texts are counted again, with the string in each row.
    """
    whole = partial.drop("term").withColumn("split", F.lit(0))
    alike = (F.col("least") == F.col("greatest")) & (F.col("first") == F.col("last"))
    several = staged(strings.filter(~alike).select("digest"), "several")
    terms = strings.filter(alike).select("digest", F.lit(0).alias("split"), F.col("least").alias("term"))
    if several.isEmpty():
        return whole, terms
    again = staged(_partial_counts(rows, digest_bits, all_terms=True).join(several, "digest", "left_semi"), "again")
    by_term = Window.partitionBy("digest").orderBy("lid", "term")
    numbered = again.select("digest", "lid", "term").distinct().withColumn("split", F.row_number().over(by_term))
    numbered = staged(numbered, "numbered")
    apart = again.join(numbered, ["digest", "lid", "term"]).drop("term")
    alone = whole.join(several, "digest", "left_anti")
    return alone.unionByName(apart), terms.unionByName(numbered.drop("lid"))


def share(n: Column, total: Column, kinds: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + kinds))``, exact whatever the counts."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", wide, (total + kinds).cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _met(terms: DataFrame) -> DataFrame:
    """``gid, other, met``: for groups that both have a term, what it adds beyond each one's own sums.

    ``terms`` has a row per term and in ``places`` its groups, each with the
    share ``p`` that the term has there and the share ``p0`` of terms it lacks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places")
            sizes = np.diff(places.offsets.to_numpy())
            flat = places.flatten()
            gid, p, p0 = (flat.field(x).to_numpy() for x in ("gid", "p", "p0"))
            names, group = np.unique(gid, return_inverse=True)
            # Each place meets the others of its term; a slice of them at a time.
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            width = np.repeat(sizes, sizes)
            start = 0
            ends = np.cumsum(width)
            while start < len(width):
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
                a = np.repeat(np.arange(start, stop), width[start:stop])
                b = np.arange(len(a)) - np.repeat(ends[start:stop] - width[start:stop] - done, width[start:stop]) + first[a]
                a, b = a[a != b], b[a != b]
                start = stop
                more = _gap(p[a], p[b]) - _gap(p[a], p0[b]) - _gap(p0[a], p[b]) + _gap(p0[a], p0[b])
                keys, at = np.unique(group[a] * len(names) + group[b], return_inverse=True)
                met = np.zeros(len(keys), dtype=np.int64)
                np.add.at(met, at, more)
                columns = [names[keys // len(names)], names[keys % len(names)], met]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["gid", "other", "met"])

    return terms.mapInArrow(run, "gid long, other long, met long")


def divergence(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, listed: int = TERMS_LISTED, digest_bits: int = 64
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each group of a language and a source.

    Kept are the terms in at least ``least_documents`` rows of a language.
    With ``count`` of ``total`` occurrences in a group, and V kept terms, a term
    has the share ``p = 1 + floor(10^9 (count + 1) / (total + V))`` there, and
    the gap of two shares is ``floor((p - q)^2 / q)``. Part ``pair`` has, for
    each other source of the language, the gap summed over all kept terms;
    part ``term`` the ``listed`` terms of the group whose gap to the language
    as a whole is largest, of those it uses more. Equal values are ranked by
    the UTF-8 of the item.

    Null text, language and source are read as empty strings, and each row is
    a document, repeated rows too. A group without terms has its pairs; where
    a language keeps no term their value is 0. Very long terms are terms like
    others. Other columns are not looked at. An empty table gives no rows.

    ``digest_bits`` shortens the digests, to test terms that share one. The
    result has a row per pair of sources of a language, so it grows with the
    square of their number, as does the work on a term that all of them have.
    """
    rows, groups = _numbered(docs)
    partial = staged(_partial_counts(rows, digest_bits), "terms")
    named = partial.filter("term IS NOT NULL").select("digest", "lid", "term").distinct()
    strings = named.groupBy("digest").agg(
        F.min("term").alias("least"), F.max("term").alias("greatest"), F.min("lid").alias("first"), F.max("lid").alias("last")
    )
    counted, terms = _split(rows, partial, staged(strings, "strings"), digest_bits)

    # From here on all are numbers.
    per_group = staged(
        counted.groupBy("lid", "gid", *TERM).agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "counts"
    )
    kept = staged(
        per_group.groupBy(*TERM, "lid")
        .agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs"))
        .filter(F.col("n_docs") >= least_documents)
        .drop("n_docs"),
        "kept",
    )
    uses = staged(per_group.drop("n_docs", "lid").join(kept, TERM), "uses")

    langs = kept.groupBy("lid").agg(F.count("*").alias("kinds"), F.sum("lang_n").alias("lang_total"))
    totals = uses.groupBy("gid").agg(F.sum("n").alias("total"), F.count("*").alias("used"))
    groups = groups.join(totals, "gid", "left").join(langs, "lid", "left").na.fill(0, ["total", "used", "kinds", "lang_total"])
    known = F.col("kinds") > 0
    groups = staged(groups.withColumn("p0", F.when(known, share(F.lit(0), F.col("total"), F.col("kinds"))).otherwise(1)), "groups")
    uses = staged(
        uses.join(groups.drop("lid", "lang", "source"), "gid")
        .withColumn("p", share(F.col("n"), F.col("total"), F.col("kinds")))
        .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("kinds")))
        .select(*TERM, "lid", "gid", "p", "q", "p0"),
        "shares",
    )
    columns = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")]
    return _pairs(uses, groups).select(columns).unionByName(_terms(uses, groups, terms, listed).select(columns))


def _pairs(uses: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums of the gaps over all kept terms, without a row for each term and pair.

    A group's terms are first taken as if the other had none of them, which
    needs only how often each share occurs; terms that neither has are alike,
    and for terms that both have the difference is added.
    """
    # Shares repeat: they depend on the count only.
    shares = staged(uses.groupBy("lid", "gid", "p").agg(F.count("*").alias("n")), "share-counts")
    others = groups.select("lid", F.col("gid").alias("other"), F.col("p0").alias("other_p0"))
    alone = (
        shares.join(others, "lid")
        .filter(F.col("gid") != F.col("other"))
        .groupBy("gid", "other")
        .agg(
            F.sum(F.col("n") * gap(F.col("p"), F.col("other_p0"))).alias("as_group"),
            F.sum(F.col("n") * gap(F.col("other_p0"), F.col("p"))).alias("as_other"),
        )
    )
    alone = staged(alone, "alone")
    met = _met(uses.groupBy(*TERM).agg(F.collect_list(F.struct("gid", "p", "p0")).alias("places")).select("places"))
    met = met.groupBy("gid", "other").agg(F.sum("met").alias("met"))
    turned = alone.select(F.col("other").alias("gid"), F.col("gid").alias("other"), "as_other")
    items = groups.select(
        "lid", F.col("gid").alias("other"), F.col("source").alias("item"), F.col("p0").alias("other_p0"), F.col("used").alias("other_used")
    )
    lacking = F.col("kinds") - F.col("used") - F.col("other_used")
    pair = ["gid", "other"]
    return (
        groups.join(items, "lid")
        .filter(F.col("gid") != F.col("other"))
        .join(alone.drop("as_other"), pair, "left")
        .join(turned, pair, "left")
        .join(met, pair, "left")
        .na.fill(0, ["as_group", "as_other", "met"])
        .withColumn("value", F.col("as_group") + F.col("as_other") + F.col("met") + lacking * gap(F.col("p0"), F.col("other_p0")))
        .withColumn("rank", F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), "item")))
        .withColumn("part", F.lit("pair"))
    )


def _terms(uses: DataFrame, groups: DataFrame, terms: DataFrame, listed: int) -> DataFrame:
    """The terms with the largest gaps; strings are joined only to those that may be listed.

    The value of the last listed term is found from how often each value
    occurs, so no task gets all terms of a group.
    """
    scored = staged(uses.filter("p > q").withColumn("value", gap(F.col("p"), F.col("q"))).select(*TERM, "gid", "value"), "scored")
    by_value = Window.partitionBy("gid").orderBy(F.desc("value"))
    values = (
        scored.groupBy("gid", "value")
        .agg(F.count("*").alias("n"))
        .select(
            "gid",
            "value",
            F.row_number().over(by_value).alias("place"),
            (F.sum("n").over(by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("before"),
        )
        .filter((F.col("place") <= listed) & (F.col("before") < listed))
    )
    last = staged(values.groupBy("gid").agg(F.min("value").alias("last")), "last")
    may = scored.join(last, "gid").filter(F.col("value") >= F.col("last")).select(*TERM, "gid", "value")
    by_rank = Window.partitionBy("gid").orderBy(F.desc("value"), "item")
    return (
        staged(may, "may")
        .join(terms.withColumnRenamed("term", "item"), TERM)
        .withColumn("rank", F.row_number().over(by_rank))
        .filter(F.col("rank") <= listed)
        .join(groups.select("gid", "lang", "source"), "gid")
        .withColumn("part", F.lit("term"))
    )
