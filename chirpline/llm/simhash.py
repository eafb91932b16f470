"""SimHash near-duplicates by tiled exact comparison of all fingerprints.

Fingerprints are put into cells by the population counts of their two halves,
and cells are cut into tiles. Two fingerprints at most ``radius`` bits apart
lie in cells whose counts differ by at most ``radius`` together, so other pairs
of tiles are skipped; the rest are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import blocks, one_of_each, staged, text_or_empty, texts_of, unused
from chirpline.llm.components import Forest, components

SEED = 42
# Fingerprints of a tile, about, and pairs compared at a time.
TILE = 1 << 14
AT_ONCE = 1 << 20
# Rows handed to Python at a time: each holds two tiles.
TILE_ROWS = 32

# Row b holds the eight bits of byte b, least first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
BYTE_PLACE = (np.arange(8) * 256)[None, :]


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, repeats included; of the whole text if it has fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype="<u8")
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], dtype="<u8")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype="<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, as a signed 64-bit number."""
    if not len(hashes):
        return 0
    bytes_ = hashes.view(np.uint8).reshape(-1, 8) + BYTE_PLACE
    counts = (np.bincount(bytes_.ravel(), minlength=2048).reshape(8, 256) @ BITS).ravel()
    packed = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 4, with_sha: bool = False) -> DataFrame:
    """``doc_id, fp`` of every row, in one pass over the texts; ``with_sha`` adds the text's SHA-256."""
    own = ["doc_id", "sha"] if with_sha else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                found = [fingerprint(shingle_hashes(x, width)) for x in texts_of(block, "text")]
                yield pa.RecordBatch.from_arrays([*(block.column(x) for x in own), pa.array(found, pa.int64())], [*own, "fp"])

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    if with_sha:
        texts = texts.withColumn("sha", F.sha2("text", 256))
    return texts.mapInArrow(run, "doc_id long, sha string, fp long" if with_sha else "doc_id long, fp long")


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within and between two tiles (signed 64-bit fingerprints)."""
    both = a if same else np.concatenate([a, b])
    forest = Forest(len(both))
    first, ua, ub = 0 if same else len(a), a.view(np.uint64), b.view(np.uint64)
    step = max(1, AT_ONCE // max(1, len(b)))
    for start in range(0, len(a), step):
        near = np.bitwise_count(ua[start : start + step, None] ^ ub[None, :]) <= radius
        if same:
            near[np.arange(len(near)), np.arange(start, start + len(near))] = False
        for row in np.flatnonzero(near.any(axis=1)):
            forest.link(start + row, first + np.flatnonzero(near[row]))
    nodes, heads = forest.edges()
    return both[nodes], both[heads]


def near_links(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints (``fp``, distinct) at most ``radius`` bits apart."""
    halves = [F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))), F.bit_count(F.shiftrightunsigned("fp", 32))]
    placed = prints.select("fp", (halves[0] * 64 + halves[1]).cast("int").alias("cell"))
    # At most 33 * 33 cells, whatever the input.
    cells = staged(
        placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks")), "cells"
    )
    tiles = staged(
        placed.join(F.broadcast(cells), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"))
        .agg(F.sort_array(F.collect_list("fp")).alias("fps")),
        "tiles",
        TILE_ROWS,
    )
    # Half of the cells around one, so that each pair of cells comes up once.
    steps = [
        (x, y) for x in range(radius + 1) for y in range(-radius, radius + 1) if x + abs(y) <= radius and (x > 0 or y >= 0)
    ]
    around = F.explode(F.array(*[F.lit(64 * x + y) for x, y in steps]))
    pairs = (
        cells.select(F.col("cell").alias("cell_a"), F.col("blocks").alias("blocks_a"), around.alias("step"))
        .withColumn("cell", F.col("cell_a") + F.col("step"))
        .join(F.broadcast(cells), "cell")
        .withColumn("block_a", F.explode(F.sequence(F.lit(0), F.col("blocks_a") - 1)))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .filter((F.col("step") != 0) | (F.col("block_a") <= F.col("block")))
        .select("cell_a", "block_a", "cell", "block")
    )
    left = tiles.select(F.col("cell").alias("cell_a"), F.col("block").alias("block_a"), F.col("fps").alias("a"))
    right = tiles.select("cell", "block", F.col("fps").alias("b"))
    compared = pairs.join(left, ["cell_a", "block_a"]).join(right, ["cell", "block"])
    compared = compared.select(
        "a", "b", ((F.col("cell") == F.col("cell_a")) & (F.col("block") == F.col("block_a"))).alias("same")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, same in zip(*(batch.column(x) for x in ("a", "b", "same")), strict=True):
                a, b = (x.values.to_numpy().astype(np.int64) for x in (a, b))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in tile_links(a, b, radius, same.as_py())], ["a", "b"])

    return staged(compared.mapInArrow(run, "a long, b long"), "near", TILE_ROWS)


def _reached(found: DataFrame, radius: int, tile: int) -> DataFrame:
    """For each fingerprint its group, named by one fingerprint of it, and the smallest ``doc_id`` there: ``fp, group, component_id``."""
    prints = staged(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    linked = staged(components(near_links(prints, radius, tile)), "linked")
    hubs = linked.join(prints, linked["node"] == prints["fp"]).groupBy("component").agg(F.min("least").alias("component_id"))
    far = linked.join(hubs, "component").select(F.col("node").alias("fp"), F.col("component").alias("group"), "component_id")
    return far.unionByName(
        prints.join(linked, prints["fp"] == linked["node"], "left_anti").select(
            "fp", F.col("fp").alias("group"), F.col("least").alias("component_id")
        )
    )


def simhash_groups(docs: DataFrame, width: int = 4, radius: int = 4, tile: int = TILE) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other. Rows that repeat, or share a ``doc_id``, each have their row.
    ``component_id`` is the smallest ``doc_id`` reached, nulls apart; it is
    null if only rows of null ``doc_id`` are reached. Other columns are not
    looked at. An empty table gives no rows.

    Copies meet in one fingerprint before any comparison, and links are
    reduced to spanning forests tile by tile, so a group of any size costs its
    comparisons and no list of pairs. The comparisons of distinct fingerprints
    grow with the square of their number.
    """
    found = staged(fingerprints(docs, width), "fingerprints")
    return found.join(_reached(found, radius, tile), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_dedup(docs: DataFrame, width: int = 4, radius: int = 4, tile: int = TILE) -> DataFrame:
    """One row of each group, one of the smallest ``doc_id``, with all its columns.

    A null ``doc_id`` stays only where the whole group has none. Of several
    rows with that id, the one whose text has the smallest SHA-256 stays, and
    of those the one whose columns have the smallest hash.
    """
    found = staged(fingerprints(docs, width, with_sha=True), "fingerprints")
    least = (
        found.join(_reached(found, radius, tile), "fp")
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("group", "doc_id", "sha")
        .count()
    )
    first = least.groupBy("group").agg(F.min(F.struct("sha", "doc_id", "count")).alias("first"))
    sha = unused(docs, "sha")
    marked = docs.withColumn(sha, F.sha2(text_or_empty(), 256))
    return one_of_each(marked, sha, staged(first.select("first.doc_id", "first.sha", "first.count"), "first"))
