"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``length`` bytes covers it which starts at two
places of the table. Suffix arrays of all texts in one piece cannot be built
by many tasks, so each string of that length is first given an anchor that
depends on its bytes alone: the place of its smallest hashed gram. Strings
with neighbouring starts mostly share their anchor; such a run, together with
the bytes around it, is a context. Equal strings lie at the same place of
contexts with the same anchor, so contexts are dealt into shards by anchor and

1. runs whose common core occurs once are left out: none of their strings is
   equal to another;
2. equal contexts, as of copied documents, become one with a count; if an
   anchor has no other, all its strings occur that often;
3. every shard builds the suffix array of its contexts (Larsson-Sadakane) and
   the common prefixes of neighbours (Kasai): a string is repeated if it
   shares ``length`` bytes with a neighbour;
4. an anchor with more contexts than a shard takes is spread over several
   shards, whose sorted strings are merged by binary search;
5. repeated strings are brought back to every document that has the context.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import blocks, staged, text_or_empty, texts_of
from chirpline.llm.suffixes import common_prefixes, joined, suffix_array

LENGTH = 400
# Bytes of an anchor's gram, a power of two.
GRAM = 32
# Runs are cut where the distance to their anchor passes a multiple of this, so that their core stays long.
STRIDE = 128
SHARD_BYTES = 1 << 20
MERGE_ROWS = 1 << 16
SHARDS_PER_TASK = 4
MOST_TASKS = 50_000
SHARD_ROWS = 16
DOC_ROWS = 500
# Text that is hashed at a time; places in it take 24 bits.
CHUNK = 1 << 20
PLACE = np.uint64((1 << 24) - 1)

MIX = np.uint64(0x9E3779B97F4A7C15)
BYTE_HASH = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, doubling the span until it is full."""
    hashes, span, factor = BYTE_HASH[text], 1, MIX
    with np.errstate(over="ignore"):
        while span < GRAM:
            hashes = hashes[:-span] * factor + hashes[span:]
            factor, span = factor * factor, span * 2
        hashes ^= hashes >> np.uint64(31)
        hashes *= MIX
        hashes ^= hashes >> np.uint64(29)
    return hashes


def running_least(values: np.ndarray, width: int) -> np.ndarray:
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        n = len(values) - width + 1
        least = np.minimum(least[:n], least[width - span : width - span + n])
    return least


def anchors(text: np.ndarray, length: int) -> np.ndarray:
    """For each string of ``length`` bytes, the distance from its start to its anchor, the first of equal grams."""
    out = []
    for start in range(0, len(text) - length + 1, CHUNK):
        hashes = gram_hashes(text[start : start + CHUNK + length - 1])
        placed = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        least = running_least(placed, length - GRAM + 1) & PLACE
        out.append(least.astype(np.int64) - np.arange(len(least)))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def runs_of(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor, as columns: text, first start, strings, distance of the first start to the anchor."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    distance = anchors(np.frombuffer(b"".join(texts), np.uint8), length)
    # Only strings inside one text.
    counts = np.maximum(sizes - length + 1, 0)
    of_text = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(len(of_text)) - np.repeat(np.cumsum(counts) - counts, counts)
    distance = distance[begins[of_text] + start]
    anchor = start + distance
    cut = (np.diff(of_text) != 0) | (np.diff(anchor) != 0) | (np.diff(distance // STRIDE) != 0)
    first = np.concatenate(([0], np.flatnonzero(cut) + 1)) if len(of_text) else np.empty(0, np.int64)
    strings = np.diff(np.concatenate((first, [len(of_text)])))
    return of_text[first], start[first], strings, distance[first]


def core_of(text: bytes, start: int, distance: int, length: int) -> int:
    """Hash of the bytes that all strings with this anchor and span of distances have in common."""
    span = distance // STRIDE
    begin = start + distance - span * STRIDE
    return xxhash.xxh64_intdigest(text[begin : begin + length - STRIDE + 1], span) - (1 << 63)


def progressions(columns: list[np.ndarray], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rows of stretches that repeat all ``columns`` at even steps, the steps, and how often.

    Texts that repeat one word have many such rows.
    """
    n = len(starts)
    if not n:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    step = np.concatenate(([0], np.diff(starts)))
    same = np.ones(n, dtype=bool)
    same[0] = False
    for column in columns:
        same[1:] &= column[1:] == column[:-1]
    goes_on = same.copy()
    goes_on[1:] &= ~same[:-1] | (step[1:] == step[:-1])
    first = np.flatnonzero(~goes_on)
    times = np.diff(np.concatenate((first, [n])))
    steps = np.where(times > 1, step[np.minimum(first + 1, n - 1)], 0)
    return first, steps, times


def repeated_in_shard(
    contexts: list[bytes], times: np.ndarray, length: int, split: bool
) -> tuple[list[np.ndarray], list[tuple[bytes, int, int, bool]]]:
    """Marks, per context, its strings that are repeated here.

    Of a shard that shares its anchors with others (``split``) also a row for
    each different string, in order: digest, context, place, whether it is
    known to be repeated.
    """
    symbols, starts = joined(contexts)
    order = suffix_array(symbols)
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    shared = common_prefixes(symbols, order, starts, length, np.maximum(sizes - length + 1, 0))
    full = shared >= length
    twice = full | np.concatenate((full[1:], [False]))
    marks = np.zeros(len(symbols), dtype=bool)
    marks[order[twice]] = True
    out = [marks[a : a + n - length + 1] | (t > 1) for a, n, t in zip(starts, sizes, times, strict=True)]
    digests = []
    if split:
        owner = np.repeat(np.arange(len(contexts)), sizes + 1)
        place = np.arange(len(symbols)) - starts[owner]
        whole = place + length <= sizes[owner]
        for p in order[~full & whole[order]].tolist():
            context, at = int(owner[p]), int(place[p])
            digest = hashlib.blake2b(contexts[context][at : at + length], digest_size=16).digest()
            digests.append((digest, context, at, bool(out[context][at])))
    return out, digests


def spans_of(marks: np.ndarray) -> list[int]:
    """Starts and ends of the marked stretches, in turn."""
    return np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0])))).tolist()


def merged(shards: np.ndarray, digests: list[bytes], known: np.ndarray) -> np.ndarray:
    """Which strings not ``known`` to be repeated occur in another shard.

    Each shard has a string once, so a binary search in the merged order that
    finds two places has found another shard's.
    """
    keys = np.array([int.from_bytes(x[:8], "big") for x in digests], np.uint64)
    rest = np.array([int.from_bytes(x[8:], "big") for x in digests], np.uint64)
    by = np.lexsort((rest, keys))
    new = np.concatenate(([True], (np.diff(keys[by]) != 0) | (np.diff(rest[by]) != 0)))[: len(by)]
    run = np.cumsum(new)
    keys[by] = run
    found = np.zeros(len(keys), dtype=bool)
    for shard in np.unique(shards):
        mine = np.flatnonzero((shards == shard) & ~known)
        wanted = keys[mine]
        found[mine] = np.searchsorted(run, wanted, side="right") - np.searchsorted(run, wanted, side="left") > 1
    return found


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)


def repeats(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, whole_sha256`` of every document.

    Texts are UTF-8 bytes, null counts as empty. A byte is removed if it is
    covered by a string of ``length`` bytes that also starts anywhere else, in
    the same document too; matches overlap freely, never cross documents, and
    are judged on the input. So the first occurrence goes as well as the later
    ones. ``kept`` are the remaining bytes, which need not be valid UTF-8, and
    ``n_spans`` the maximal removed runs. Where no string could be repeated,
    ``kept`` is null and ``whole_sha256`` the digest of the whole text.

    Rows that repeat are documents of their own and so remove each other's
    strings. A null ``doc_id`` is an id like any other. Texts under ``length``
    bytes lose nothing. Other columns are not looked at. An empty table gives
    no rows. Contexts are told apart by 128-bit BLAKE2b digests.
    """
    if length < GRAM + STRIDE:
        raise ValueError(f"length must be at least {GRAM + STRIDE}")
    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    key = ["doc_id", "text_hash"]

    def find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = texts_of(block, "text")
                of_text, start, strings, distance = runs_of(texts, length)
                each = zip(of_text.tolist(), start.tolist(), distance.tolist(), strict=True)
                cores = np.fromiter((core_of(texts[i], s, d, length) for i, s, d in each), np.int64, len(start))
                first, steps, times = progressions([of_text, cores, strings, distance], start)
                ids = [block.column(x).take(pa.array(of_text[first])) for x in key]
                values = [cores[first], start[first], strings[first], distance[first], steps, times]
                yield pa.RecordBatch.from_arrays(
                    [*ids, *map(pa.array, values)], [*key, "core", "start", "strings", "distance", "step", "times"]
                )

    places = staged(
        source.mapInArrow(
            find_runs,
            "doc_id long, text_hash long, core long, start long, strings long, distance long, step long, times long",
        ),
        "places",
    )
    # Written before the join, which can then be split where very many places share a core.
    twice = staged(places.groupBy("core").agg(F.sum("times").alias("n")).filter("n > 1").select("core"), "twice")
    run_fields = ["start", "strings", "distance", "step", "times"]
    per_doc = (
        places.join(twice, "core", "left_semi").groupBy(*key).agg(F.collect_set(F.struct(*run_fields)).alias("runs"))
    )
    met = source.alias("s").join(per_doc.alias("p"), _same("s", "p"), "left")
    # Texts go on only where a run of theirs may be repeated.
    judged = staged(
        met.select(
            "s.doc_id",
            "s.text_hash",
            F.octet_length("s.text").cast("long").alias("n_bytes"),
            F.when(F.col("runs").isNotNull(), F.col("text")).alias("text"),
            F.when(F.col("runs").isNull(), F.sha2("text", 256)).alias("whole_sha256"),
            "runs",
        ),
        "judged",
        DOC_ROWS,
    )
    open_ = judged.filter("runs IS NOT NULL")

    def find_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*key, "anchor", "context", "strings", "starts"]
        kinds = [pa.int64()] * 3 + [pa.binary(), pa.int64(), pa.list_(pa.int64())]
        for batch in batches:
            for block in blocks(batch, "text"):
                rows = []
                ids = [block.column(x).to_pylist() for x in key]
                all_runs = block.column("runs").to_pylist()
                for doc_id, text_hash, text, runs in zip(*ids, texts_of(block, "text"), all_runs, strict=True):
                    spread = sorted(
                        (r["start"] + i * r["step"], r["strings"], r["distance"])
                        for r in runs
                        for i in range(r["times"])
                    )
                    # Neighbours with one anchor are one context again.
                    wide: list[list[int]] = []
                    for start, strings, distance in spread:
                        if wide and wide[-1][0] + wide[-1][1] == start and wide[-1][2] == start + distance:
                            wide[-1][1] += strings
                        else:
                            wide.append([start, strings, start + distance])
                    found: dict[tuple[int, bytes, int], list[int]] = {}
                    for start, strings, anchor in wide:
                        gram = xxhash.xxh64_intdigest(text[anchor : anchor + GRAM]) - (1 << 63)
                        digest = hashlib.blake2b(text[start : start + strings + length - 1], digest_size=16).digest()
                        found.setdefault((gram, digest, strings), []).append(start)
                    rows += [(doc_id, text_hash, *what, starts) for what, starts in found.items()]
                yield _rows(rows, names, kinds)

    held = staged(
        open_.select(*key, "text", "runs").mapInArrow(
            find_contexts, "doc_id long, text_hash long, anchor long, context binary, strings long, starts array<long>"
        ),
        "contexts",
        DOC_ROWS,
    )
    classes = staged(
        held.groupBy("anchor", "context").agg(
            F.min(F.struct(*key, F.element_at("starts", 1).alias("start"))).alias("at"),
            F.min("strings").alias("strings"),
            F.sum(F.size("starts")).alias("times"),
        ),
        "classes",
    )
    size = F.col("strings") + length - 1
    per_anchor = staged(
        classes.groupBy("anchor").agg(F.sum(size).alias("held"), F.count("*").alias("n_contexts")), "anchors"
    )
    # Strings of one context differ in their distance to the anchor, so in one context none is equal to another.
    alone = classes.join(per_anchor.filter("n_contexts = 1").select("anchor"), "anchor", "left_semi").filter("times > 1")
    sized = per_anchor.filter("n_contexts > 1")
    total = sized.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    parts = F.ceil(F.col("held") / shard_bytes).cast("int")
    wanted = classes.join(sized, "anchor").select(
        "at.*",
        "anchor",
        "context",
        "strings",
        "times",
        F.when(parts > 1, F.col("anchor")).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards))).alias("shard"),
        F.when(parts > 1, 1 + F.pmod(F.xxhash64("context"), parts)).otherwise(0).alias("part"),
    )
    wanted_fields = ["start", "strings", "anchor", "context", "times", "shard", "part"]
    cut_up = open_.select(*key, "text").dropDuplicates(key).alias("s").join(
        wanted.groupBy(*key).agg(F.collect_list(F.struct(*wanted_fields)).alias("wanted")).alias("p"), _same("s", "p")
    )

    def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "part", "anchor", "context", "times", "bytes"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        for batch in batches:
            for block in blocks(batch, "text"):
                rows = []
                for text, wanted in zip(texts_of(block, "text"), block.column("wanted").to_pylist(), strict=True):
                    for w in wanted:
                        cut = text[w["start"] : w["start"] + w["strings"] + length - 1]
                        rows.append((w["shard"], w["part"], w["anchor"], w["context"], w["times"], cut))
                yield _rows(rows, names, kinds)

    # Few shards a task, as each takes about a second.
    tasks = min(MOST_TASKS, -(-shards // SHARDS_PER_TASK))
    dealt = (
        cut_up.select("text", "wanted")
        .mapInArrow(cut_contexts, "shard long, part int, anchor long, context binary, times long, bytes binary")
        .repartition(tasks, "shard", "part")
        .groupBy("shard", "part")
        .agg(F.collect_list(F.struct("anchor", "context", "times", "bytes")).alias("held"))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["context", "spans", "anchor", "digest", "part", "at", "known"]
        kinds = [pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.bool_()]
        for batch in batches:
            for part, held in zip(batch.column("part").to_pylist(), batch.column("held"), strict=True):
                texts = held.values.field("bytes").to_pylist()
                contexts = held.values.field("context").to_pylist()
                times = held.values.field("times").to_numpy()
                marks, digests = repeated_in_shard(texts, times, length, part > 0)
                rows: list[tuple] = [
                    (context, spans_of(mark), None, None, None, None, None)
                    for context, mark in zip(contexts, marks, strict=True)
                    if mark.any()
                ]
                owners = held.values.field("anchor").to_pylist()
                rows += [(contexts[i], None, owners[i], digest, part, at, known) for digest, i, at, known in digests]
                yield _rows(rows, names, kinds)

    searched = staged(
        dealt.select("part", "held").mapInArrow(
            search, "context binary, spans array<long>, anchor long, digest binary, part int, at long, known boolean"
        ),
        "searched",
        SHARD_ROWS,
    )
    in_shards = searched.filter("spans IS NOT NULL").select("context", "spans")
    across = searched.filter("digest IS NOT NULL").drop("spans")
    buckets = max(1, across.count() // MERGE_ROWS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.column("rows"):
                fields = {x: held.values.field(x) for x in ("context", "digest", "part", "at", "known")}
                known = fields["known"].to_numpy(zero_copy_only=False)
                found = merged(fields["part"].to_numpy(), fields["digest"].to_pylist(), known)
                at = fields["at"].to_numpy()[found].tolist()
                contexts = [x for x, f in zip(fields["context"].to_pylist(), found.tolist(), strict=True) if f]
                rows = [(context, [place, place + 1]) for context, place in zip(contexts, at, strict=True)]
                yield _rows(rows, ["context", "spans"], [pa.binary(), pa.list_(pa.int64())])

    # A string's digest names its anchor's shards too: equal strings have equal anchors.
    by_range = across.groupBy("anchor", F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("range")).agg(
        F.collect_list(F.struct("context", "digest", "part", "at", "known")).alias("rows")
    )
    between = staged(
        by_range.select("rows").mapInArrow(merge, "context binary, spans array<long>"), "between", SHARD_ROWS
    )
    counted = alone.select("context", F.array(F.lit(0).cast("long"), F.col("strings")).alias("spans"))
    # Written first, so that the join with a context of very many documents can be split.
    searched = in_shards.unionByName(between)
    searched = searched.groupBy("context").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    found = staged(counted.unionByName(searched), "found")
    per_open = (
        held.join(found, "context")
        .groupBy(*key)
        .agg(F.collect_list(F.struct("starts", "spans")).alias("found"))
    )
    told = open_.alias("s").join(per_open.alias("p"), _same("s", "p"), "left").select("s.doc_id", "n_bytes", "text", "found")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        kinds = [pa.int64()] * 4 + [pa.binary()]
        for batch in batches:
            for block in blocks(batch, "text"):
                rows = []
                for doc_id, text, found in zip(
                    block.column("doc_id").to_pylist(), texts_of(block, "text"), block.column("found").to_pylist(), strict=True
                ):
                    edge = np.zeros(len(text) + 1, np.int64)
                    for x in found or ():
                        spans, starts = np.array(x["spans"], np.int64).reshape(-1, 2), np.array(x["starts"], np.int64)
                        np.add.at(edge, (starts[:, None] + spans[None, :, 0]).ravel(), 1)
                        np.add.at(edge, (starts[:, None] + spans[None, :, 1] + length - 1).ravel(), -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    rows.append((doc_id, len(text), int(gone.sum()), len(spans_of(gone)) // 2, kept))
                yield _rows(rows, names, kinds)

    done = told.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    untouched = judged.filter("runs IS NULL").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), "whole_sha256"
    )
    return done.withColumn("whole_sha256", F.lit(None).cast("string")).unionByName(
        untouched.withColumn("kept", F.lit(None).cast("binary"))
    )


def _same(left: str, right: str):
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (
        F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash")
    )


def repeat_digests(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document; see :func:`repeats`."""
    return repeats(docs, **options).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.coalesce("whole_sha256", F.sha2("kept", 256)).alias("kept_sha256")
    )
