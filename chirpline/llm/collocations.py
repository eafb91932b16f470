"""Phrase mining by dynamic itemset counting.

The documents lie in shards that are scanned in a cycle. Words are counted
from the start. After each shard, phrases that have reached the threshold are
marked with the number of that stop, and a longer phrase is counted from the
stop on at which both its subphrases, all but its last and all but its first
word, are marked. It is counted until it has seen every shard once, so phrases
of all lengths are counted in the same scans, each over all documents exactly
once.

Marks are kept in arrays of fixed size, like a Bloom filter that remembers
when; their size is fixed. They are the same for all tasks of a scan and a mark never changes, so
the start of a phrase is known wherever it is met. Where the arrays mark a
phrase too much, phrases are counted that need not be; their counts are whole
all the same.

Rows of phrases are numbers only. They travel as packed arrays, one for each
bucket of digests, and are sorted and added up bucket by bucket, as most
phrases are rare and a row of its own for each would cost more than its count.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirpline.llm.common import BATCH_ROWS, blocks, staged, text_or_empty, texts_of
from chirpline.session import scratch, settings
from chirpline.sources import files

# Longest phrase, threshold, scale of scores, share of a longer phrase, phrases listed per language.
LONGEST = 4
LEAST = 30
SCALE = 2_000_000
SHARE_PERCENT = 80
LISTED = 2_000

SHARDS = 3
# Bytes of each array of marks; there is one for each length but the last.
CELLS = 1 << 24
# Bytes of text whose phrases a task sums up before it hands them on.
HELD_BYTES = 4 << 20

# Separators of pieces become line feeds, tabs blanks, A to Z small letters.
FOLD = bytes(0x0A if x in b".,;:!?\n\x0b\x0c\r" else 0x20 if x == 0x09 else x for x in range(256)).lower()

# A row is a digest, how often it was counted, and four small numbers in one. From the top: the length, the
# stop at which counting started, the stop at which the threshold was reached, and a place: a block that holds
# the phrase, below bits which are as good as random, so that the largest place is that of any such block.
# Those bits are there only while rows are added up.
COUNTED = "high long, low long, n long, kind long"
STOP_BITS = 6
STOPS = 1 << STOP_BITS
BLOCK_BITS = 24
PLACE_BITS = 2 * BLOCK_BITS

# Rows of phrases as the bytes of four arrays, one below the other, for each bucket of digests.
PACKED = "bucket int, rows binary"
# Rows of a bucket if every place in a shard began a phrase of each length, and bits of the least number of buckets.
BUCKET_ROWS = 1 << 20
BUCKET_BITS = 4
# Of the phrases after a step: those still counted, those that have seen every shard, and those that have just
# reached the threshold, which are also with one of the others.
OPEN, OVER, NEW = "open", "over", "new"

# Bytes of coded texts, or of packed rows, that a task gets at a time, and one such row at least.
BATCH_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
# Blocks of coded texts that a task gets at a time to look up phrases.
BLOCK_ROWS = {BATCH_ROWS: "1"}
# Bits of the table by which a task tells places that cannot begin a wanted phrase.
WANTED_BITS = 20


def _kind(length: int, start: np.ndarray, block: int) -> np.ndarray:
    return ((length << STOP_BITS | start.astype(np.int64)) << STOP_BITS) << PLACE_BITS | block


def _parts(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length, start and stop."""
    stops = kind >> PLACE_BITS
    return stops >> 2 * STOP_BITS, stops >> STOP_BITS & STOPS - 1, stops & STOPS - 1


def _order(keys: np.ndarray) -> np.ndarray:
    """Places of 64-bit numbers by size: their top bits are sorted with their places below, then the few that are left."""
    mask = np.uint64((1 << len(keys).bit_length()) - 1)
    places = keys & ~mask | np.arange(len(keys), dtype=np.uint64)
    places.sort()
    places = (places & mask).astype(np.int64)
    keys = keys[places]
    return places[np.argsort(keys, kind="stable")] if (keys[1:] < keys[:-1]).any() else places


def _firsts(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Where another digest begins."""
    return np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))


def _summed(rows: np.ndarray) -> np.ndarray:
    """One row for each digest."""
    rows = rows.take(_order(rows[1].view(np.uint64)), axis=1)
    same = rows[1, 1:] == rows[1, :-1]
    if (rows[0, 1:][same] != rows[0, :-1][same]).any():  # digests that differ in one half only
        rows = rows.take(np.lexsort((rows[0], rows[1])), axis=1)
    high, low, n, kind = rows
    order = (low ^ kind & (1 << BLOCK_BITS) - 1).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BLOCK_BITS)
    first = _firsts(high, low)
    kind = np.maximum.reduceat(kind | order.astype(np.int64) << BLOCK_BITS, first)
    kind &= ~(((1 << BLOCK_BITS) - 1) << BLOCK_BITS)
    return np.stack([high[first], low[first], np.add.reduceat(n, first), kind])


class Marks:
    """At which stop a phrase was first seen to have reached the threshold, 0 if not yet."""

    def __init__(self, cells: int):
        self.cells = cells
        self.stops = np.zeros((LONGEST - 1, cells), dtype=np.uint8)

    def __getstate__(self) -> tuple[int, bytes]:
        return self.cells, pa.compress(self.stops.tobytes(), "zstd", asbytes=True)

    def __setstate__(self, state: tuple[int, bytes]) -> None:
        self.cells = state[0]
        stops = pa.decompress(state[1], (LONGEST - 1) * self.cells, "zstd", asbytes=True)
        self.stops = np.frombuffer(stops, dtype=np.uint8).reshape(LONGEST - 1, self.cells)

    def add(self, length: np.ndarray, word: np.ndarray, bits: np.ndarray, stop: int) -> None:
        """Mark cells, given as 64 bits for each word of them, that are not marked yet."""
        row, bit = np.nonzero(np.unpackbits(bits.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        at = length[row] - 1, word[row] * 64 + bit
        new = self.stops[at] == 0
        self.stops[at[0][new], at[1][new]] = stop

    def of(self, length: int, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(self.cells - 1)
        stops = self.stops[length - 1]
        a, b = stops[hashes & mask], stops[(hashes >> np.uint64(32)) & mask]
        return np.where((a > 0) & (b > 0), np.maximum(a, b), 0)


def coded(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different words of some texts, and the texts as their numbers from 1; 0 stands between pieces."""
    text = np.frombuffer(b"\n".join(texts).translate(FOLD), dtype=np.uint8)
    between = text == 0x0A
    inside = ~(between | (text == 0x20))
    begins = inside & ~np.append(False, inside[:-1])
    at = np.flatnonzero(begins | between)
    word = begins[at]
    kept = word | np.append(True, word[:-1])  # what stands between pieces, once
    letters = text[inside]
    starts = np.flatnonzero(begins[inside])
    buffers = [None, pa.py_buffer(np.append(starts, len(letters))), pa.py_buffer(letters)]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    ids = np.zeros(len(at), dtype=np.int32)
    ids[word] = words.indices.to_numpy() + 1
    return _list_of(words.dictionary), ids[kept]


def _list_of(words: pa.LargeBinaryArray) -> list[bytes]:
    if not len(words):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pa.compute.binary_join(whole, pa.scalar(b"\n", pa.large_binary()))[0].as_py().split(b"\n")


class Tokens:
    """Coded texts of one language.

    Phrases are told apart by the numbers of their words here and by 128-bit
    digests elsewhere, in two halves of which the second gives the cells.
    """

    def __init__(self, lang: str, words: list[bytes], ids: np.ndarray, seed: int):
        self.words = [b"\n", *words]
        self.ids = ids.astype(np.int64)
        base = xxhash.xxh64_intdigest(lang.encode(), seed)
        halves = b"".join([xxhash.xxh3_128_digest(x, base) for x in self.words])
        self.own = np.ascontiguousarray(np.frombuffer(halves, dtype=">u8").reshape(-1, 2).T.astype(np.uint64))

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: which places begin a phrase within one piece, and the digests there."""
        inside, hashes = self.ids > 0, self.own.take(self.ids, axis=1)
        yield 1, inside, hashes
        for length in range(2, min(LONGEST, len(self.ids)) + 1):
            last = self.ids[length - 1 :]
            inside = inside[:-1] & (last > 0)
            hashes = _extended(hashes[:, :-1], self.own.take(last, axis=1))
            yield length, inside, hashes

    def different(self, length: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place of each different phrase at some places, and how often it is there."""
        key = self.ids[at]
        for k in range(1, length):
            if k > 1:
                key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            key = key << 32 | self.ids[at + k]
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        return at[first], n

    def text(self, length: int, place: int) -> bytes:
        return b" ".join([self.words[x] for x in self.ids[place : place + length]])


def _extended(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Digests of phrases with one more word."""
    factor = np.array([[0x9E3779B97F4A7C15], [0xC2B2AE3D27D4EB4F]], dtype=np.uint64)
    h = (hashes ^ (word >> np.uint64(7))) * factor + word
    return h ^ (h >> np.uint64(31))


def _total(lang: str, seed: int) -> np.ndarray:
    """What stands for all words of a language."""
    return np.frombuffer(xxhash.xxh3_128_digest(lang.encode(), seed), dtype=">u8").astype(np.uint64)


def phrase_counts(lang: str, tokens: Tokens, marks: Marks | None, step: int, shards: int, seed: int = 0) -> Iterator[tuple]:
    """``digests, length, start, n`` of the phrases that are counted in this step, by length.

    Length 0 is the number of all words.
    """
    if step <= shards:
        n = np.bincount(tokens.ids, minlength=len(tokens.words))[1:]
        if len(n):
            yield tokens.own[:, 1:], 1, np.zeros(len(n), dtype=np.int64), n
            yield _total(lang, seed)[:, None], 0, np.zeros(1, dtype=np.int64), n.sum()[None]
    if marks is None:
        return
    of_words = marks.of(1, tokens.own[1])
    of_words[0] = 0  # what stands between pieces ends all phrases
    stops = np.append(of_words[tokens.ids], 0)
    at = np.flatnonzero(stops)
    hashes = tokens.own.take(tokens.ids[at], axis=1)
    for length in range(2, LONGEST + 1):
        both = np.flatnonzero(stops[at + 1])
        at = at[both]
        hashes = _extended(hashes.take(both, axis=1), tokens.own.take(tokens.ids[at + length - 1], axis=1))
        start = np.maximum(stops[at], stops[at + 1])
        counted = np.flatnonzero(start >= step - shards)
        if len(counted):
            counted = counted[_order(hashes[1, counted])]
            found = hashes.take(counted, axis=1)
            first = _firsts(*found)
            yield found.take(first, axis=1), length, start[counted[first]].astype(np.int64), np.diff(np.append(first, len(counted)))
        if length < LONGEST:
            own = marks.of(length, hashes[1])
            stops = np.zeros_like(stops)
            stops[at] = own
            own = np.flatnonzero(own)
            at, hashes = at[own], hashes.take(own, axis=1)


def _blocks_of_language(batches: Iterator[pa.RecordBatch], held_bytes: int) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, of ``held_bytes`` if there are as many; four times that is held at most."""
    held: dict[str, list[bytes]] = defaultdict(list)
    sizes: dict[str, int] = defaultdict(int)
    for batch in batches:
        for block in blocks(batch, "text"):
            for lang, text in zip(block.column("lang").to_pylist(), texts_of(block, "text"), strict=True):
                held[lang].append(text)
                sizes[lang] += len(text)
            everything = sum(sizes.values()) >= 4 * held_bytes
            for lang in [x for x, size in sizes.items() if everything or size >= held_bytes]:
                yield lang, held.pop(lang)
                del sizes[lang]
    yield from held.items()


def _dealt(rows: DataFrame, shards: int, held_bytes: int) -> DataFrame:
    """Texts coded once for all scans: ``lang, words, ids, block, size, shard``, a row for what a task holds of a language at a time.

    Blocks may share a number, at worst to be looked at together.
    """

    names = ["lang", "words", "ids", "block", "size", "shard"]
    kinds = [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for turn, (lang, texts) in enumerate(_blocks_of_language(batches, held_bytes)):
            words, ids = coded(texts)
            block = xxhash.xxh64_intdigest(f"{task} {turn}") >> (64 - BLOCK_BITS)
            values = (lang, b"\n".join(words), ids.tobytes(), block, len(ids), (task + turn) % shards)
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], names)

    return rows.mapInArrow(run, "lang string, words binary, ids binary, block long, size long, shard int")


def _tokens(batch: pa.RecordBatch, seed: int) -> Iterator[tuple[str, int, Tokens]]:
    for lang, words, ids, block in zip(*(batch.column(x) for x in ("lang", "words", "ids", "block")), strict=True):
        known = words.as_py()
        numbers = np.frombuffer(ids.as_buffer(), dtype=np.int32)
        yield lang.as_py(), block.as_py(), Tokens(lang.as_py(), known.split(b"\n") if known else [], numbers, seed)


class Sent(NamedTuple):
    """What all tasks of a scan get: the marks, if there are any yet, and how many bits of a digest tell its bucket."""

    marks: Marks | None
    bits: int


def _bucketed(hashes: np.ndarray, n: np.ndarray, kind: np.ndarray, bits: int) -> pa.RecordBatch:
    """Packed rows, for each bucket that has any."""
    rows = np.stack([*(np.ascontiguousarray(x).view(np.int64) for x in hashes), n.astype(np.int64), kind])
    low = rows[1].view(np.uint64)
    if (low[1:] < low[:-1]).any():
        rows = rows.take(_order(low), axis=1)
    ends = np.searchsorted(rows[1].view(np.uint64) >> np.uint64(64 - bits), np.arange(1 << bits, dtype=np.uint64), side="right")
    starts = np.concatenate([[0], ends[:-1]])
    full = np.flatnonzero(ends > starts)
    packed = [rows[:, a:b].tobytes() for a, b in zip(starts[full].tolist(), ends[full].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(packed, pa.binary())], ["bucket", "rows"])


def _scan(shard: DataFrame, sent: Broadcast[Sent], step: int, shards: int, seed: int) -> DataFrame:
    """What one shard adds to the phrases counted in this step, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, bits = sent.value
        for batch in batches:
            for lang, block, tokens in _tokens(batch, seed):
                for hashes, length, start, n in phrase_counts(lang, tokens, marks, step, shards, seed):
                    yield _bucketed(hashes, n, _kind(length, start, block), bits)

    return shard.mapInArrow(run, PACKED)


def _rows_of(packed: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.int64).reshape(4, -1) for x in packed], axis=1)


def _added_up(found: DataFrame, step: int, least: int, shards: int) -> DataFrame:
    """The phrases after a step, packed by what becomes of them."""

    def run(table: pa.Table) -> pa.Table:
        rows = _summed(_rows_of(table.column("rows")))
        length, start, stop = _parts(rows[3])
        reached = (stop == 0) & (rows[2] >= least) & (length > 0)
        rows[3, reached] += step << PLACE_BITS
        # A phrase is over once it has seen every shard, and done with if that did not get it to the threshold.
        over = start + shards <= step
        lots = {OPEN: ~over, OVER: over & (reached | (stop > 0) | (length == 0)), NEW: reached & (length < LONGEST)}
        lots = {part: rows[:, lot].tobytes() for part, lot in lots.items() if lot.any()}
        bucket = pa.array([table.column("bucket")[0].as_py()] * len(lots), pa.int32())
        return pa.table([bucket, pa.array(lots.values(), pa.binary()), pa.array(lots, pa.string())], ["bucket", "rows", "part"])

    return found.groupBy("bucket").applyInArrow(run, f"{PACKED}, part string")


def _unpacked(packed: DataFrame) -> DataFrame:
    """``high, low, length, n, block`` of packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _rows_of(batch.column("rows"))], ["high", "low", "n", "kind"])

    length = F.shiftright("kind", PLACE_BITS + 2 * STOP_BITS).alias("length")
    block = F.col("kind").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long")).alias("block")
    return packed.select("rows").mapInArrow(run, COUNTED).select("high", "low", length, "n", block)


def found_texts(lang: str, tokens: Tokens, wanted: dict[tuple[int, int], int], seed: int) -> list[tuple[tuple[int, int], bytes]]:
    """Digests and texts of phrases of a block; ``wanted`` has the lengths by digest. Length 0 is the language as a whole."""
    total = tuple(_total(lang, seed).tolist())
    found = [(total, b"")] if total in wanted else []
    mask = np.uint64((1 << WANTED_BITS) - 1)
    for length, inside, hashes in tokens.phrases():
        lows = np.array([low for (_, low), n in wanted.items() if n == length], dtype=np.uint64)
        may = np.zeros(1 << WANTED_BITS, dtype=bool)
        may[lows & mask] = True
        at = np.flatnonzero(may[hashes[1] & mask] & inside)
        at = at[np.isin(hashes[1][at], lows)]
        if len(at):
            at, _ = tokens.different(length, at)
            digests = zip(*hashes[:, at].tolist(), strict=True)
            found += [(x, tokens.text(length, i)) for i, x in zip(at.tolist(), digests, strict=True) if x in wanted]
    return found


def _texts(dealt: DataFrame, counted: DataFrame, seed: int) -> DataFrame:
    """``high, low, lang, phrase`` of counted phrases, each looked up in one block that holds it."""
    asked = counted.groupBy("block").agg(F.collect_list(F.struct("high", "low", "length")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (lang, _, tokens), wanted in zip(_tokens(batch, seed), batch.column("wanted"), strict=True):
                columns = [wanted.values.field(x).to_numpy() for x in ("high", "low", "length")]
                high, low = (x.view(np.uint64).tolist() for x in columns[:2])
                found = found_texts(lang, tokens, dict(zip(zip(high, low, strict=True), columns[2].tolist(), strict=True)), seed)
                if found:
                    digests, names = zip(*found, strict=True)
                    halves = np.array(digests, dtype=np.uint64).view(np.int64).T
                    names = pa.array(names, pa.binary()).cast(pa.string())
                    columns = [*(pa.array(x) for x in halves), pa.array([lang] * len(found)), names]
                    yield pa.RecordBatch.from_arrays(columns, ["high", "low", "lang", "phrase"])

    met = dealt.join(asked, "block").select("lang", "words", "ids", "block", "wanted")
    return met.mapInArrow(run, "high long, low long, lang string, phrase string").distinct()


def _add_marks(marks: Marks, reached: DataFrame, stop: int) -> bool:
    """Mark the phrases; the driver gets one bit per cell. Whether there were any."""
    mask = F.lit(marks.cells - 1).cast("long")
    cells = F.array(F.col("low").bitwiseAND(mask), F.shiftrightunsigned("low", 32).bitwiseAND(mask))
    bits = (
        reached.select("length", F.explode(cells).alias("cell"))
        .groupBy("length", F.shiftrightunsigned("cell", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(cell % 64 AS INT))")).alias("bits"))
        .toArrow()
    )
    if bits.num_rows:
        marks.add(*(bits.column(x).to_numpy() for x in ("length", "word", "bits")), stop)
    return bits.num_rows > 0


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, shards: int = SHARDS, cells: int = CELLS, held_bytes: int = HELD_BYTES, seed: int = 0
) -> DataFrame:
    """``lang, phrase, length, n`` of all phrases of 1 to 4 words that occur ``least`` times in a language.

    Texts are lower-cased from A to Z and cut into pieces at ``.,;:!?`` and
    line ends, pieces into words at blanks and tabs; phrases lie in one piece,
    and overlapping occurrences count. Length 0 has the number of all words of
    a language. A null language is ``und``; null and empty texts have no
    words; each row counts, repeated ones too. ``cells`` must be a power of two.

    Only digests of phrases are counted and shuffled; the phrases that stay
    get their text from one block of texts that holds them. Should one digest
    stand for two phrases there, all is counted again with other digests.
    """
    spark = docs.sparkSession
    if not 1 <= LONGEST * shards < STOPS:
        raise ValueError("the number of shards must be from 1 to 15")
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    dealt = staged(_dealt(rows.filter("text <> ''"), shards, held_bytes), "shards", by="shard")
    while True:
        counted = _count(dealt, least, shards, cells, seed)
        texts = staged(_texts(dealt.drop("shard"), counted, seed), "texts", int(BLOCK_ROWS[BATCH_ROWS]))
        if texts.groupBy("high", "low").count().filter("count > 1").isEmpty():
            return staged(texts.join(counted, ["high", "low"]).select("lang", "phrase", "length", "n"), "phrases")
        seed += 1


def _count(dealt: DataFrame, least: int, shards: int, cells: int, seed: int) -> DataFrame:
    """``high, low, length, n, block`` of all digests that reach the threshold, and of each language as a whole."""
    spark = dealt.sparkSession
    marks, last = Marks(cells), 0
    done: list[DataFrame] = []
    most = LONGEST * (dealt.agg(F.sum("size")).first()[0] or 0) // shards
    bits = max(BUCKET_BITS, (most // BUCKET_ROWS).bit_length())
    with scratch(spark, "phrase-counts") as folder, settings(spark, BATCH_BYTES):
        counts = None
        for step in itertools.count(1):
            if step > max(shards, last + shards):
                break
            sent = spark.sparkContext.broadcast(Sent(marks if last else None, bits))  # arrays of a fixed size
            shard = dealt.filter(F.col("shard") == (step - 1) % shards).drop("shard")
            found = _scan(shard, sent, step, shards, seed)
            if counts is not None:
                found = found.unionByName(counts.filter(F.col("part") == OPEN).drop("part"))
            summed = _added_up(found, step, least, shards)
            path = f"{folder}/{step}"
            summed.write.option("compression", "zstd").partitionBy("part").parquet(path)
            counts = spark.read.schema(summed.schema).parquet(path)
            sent.destroy()
            if _add_marks(marks, _unpacked(counts.filter(F.col("part") == NEW)), step):
                last = step
            done.append(_unpacked(counts.filter(F.col("part") == OVER)))
            files.remove(spark, f"{folder}/{step - 1}/part={OPEN}")
        return staged(reduce(DataFrame.unionByName, done), "frequent")


def collocations(
    docs: DataFrame, least: int = LEAST, listed: int = LISTED, shards: int = SHARDS, cells: int = CELLS, held_bytes: int = HELD_BYTES
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``listed`` best phrases of 2 to 4 words of each language.

    ``a`` is how often a phrase occurs, ``l`` and ``r`` how often its two
    parts do at the cut with the smallest ``score = floor(2000000 a / (l + r))``,
    the first of equal ones, and ``n`` the words of the language. Phrases
    inside a longer frequent one that occurs at least 80% as often are left
    out. Order is by score, then ``a``, then the UTF-8 of the phrase.

    Words, null values and repeated rows are those of ``frequent_phrases``.
    Other columns are not looked at. An empty table, and a language without
    frequent phrases, give no rows.
    """
    counted = frequent_phrases(docs, least, shards, cells, held_bytes)
    candidates = counted.filter("length > 1").select("lang", "phrase", "length", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    def counts_of(column: str, name: str) -> DataFrame:
        return counted.filter("length > 0").select("lang", F.col("phrase").alias(column), F.col("n").alias(name))

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("length") - F.col("k")).alias("right")
    )
    halved = cuts.join(counts_of("left", "l"), ["lang", "left"]).join(counts_of("right", "r"), ["lang", "right"])
    wide = F.lit(SCALE).cast("decimal(10,0)") * F.col("a").cast("decimal(20,0)")
    score = F.call_function("div", wide, (F.col("l") + F.col("r")).cast("decimal(20,0)"))
    scored = halved.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # What longer phrases hold, each with the count of the most frequent of them.
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("length") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("length") - size + 1), lambda start: part(start, size)),
        )
    )
    within = candidates.filter("length > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    within = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.coalesce(100 * F.col("longer") >= SHARE_PERCENT * F.col("a"), F.lit(False))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.join(within, ["lang", "phrase"], "left")
        .filter(~covered)
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= listed)
        .join(counted.filter("length = 0").groupBy("lang").agg(F.sum("n").alias("n")), "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
