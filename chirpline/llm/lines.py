"""Line dedup by winnowing over line hashes.

The lines of a document that are not blank are hashed. Of every run of
``window`` successive ``gram``-line hashes the smallest is selected, so a run
of ``window + gram - 1`` lines that occurs twice has the same fingerprint, at
the same place, both times. Shorter runs that hold many words, such as a
paragraph in one line, are fingerprints as a whole. Positions join on repeated
fingerprints; around each such position the matches are extended both ways,
line by line, and of every repeated run all but the first occurrence are
deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import blocks, staged, text_or_empty, texts_of

GRAM = 2
WINDOW = 2
# A shorter run counts too if it has so many words.
LEAST_WORDS = 50
SPACE_BYTES = b" \t\n\r\x0b\x0c"


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hashes of the lines that are not blank, stripped of white space around them, their line numbers, and the lines."""
    lines = [x.strip(SPACE_BYTES) for x in text.split(b"\n")]
    kept = [i for i, x in enumerate(lines) if x]
    lines = [lines[i] for i in kept]
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(x) for x in lines], dtype=np.uint64).view(np.int64), np.array(kept, dtype=np.int64), lines


def wordy_runs(lines: list[bytes], longest: int, least: int) -> list[tuple[int, int]]:
    """Place and length of the runs of up to ``longest`` lines that hold ``least`` words or more."""
    ends = np.cumsum([0, *(len(x.split()) for x in lines)])
    return [(at, n) for n in range(1, longest + 1) for at in np.flatnonzero(ends[n:] - ends[:-n] >= least).tolist()]


def gram_hashes(hashes: np.ndarray, gram: int) -> np.ndarray:
    """One hash for each run of ``gram`` line hashes."""
    h = hashes.view(np.uint64)
    n = max(0, len(h) - gram + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(gram):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` hashes, the place of its smallest, the last of equal ones."""
    n = len(grams) - window + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.arange(n) + window - 1 - runs[:, ::-1].argmin(axis=1)


def line_dedup(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds ``n_lines, n_removed, n_runs, kept_text`` to ``doc_id`` and ``text``, a row per document.

    A run of lines, blank ones left out and white space around lines too, which
    also occurs earlier is deleted if it has ``window + gram - 1`` lines or
    ``least_words`` words; earlier is a smaller ``doc_id``, then an earlier
    line of the same document. Words are parted by ASCII white space. Matches
    are taken in the input, so overlapping repeats count. ``n_lines`` counts
    all lines, a null or empty text has one; ``n_runs`` counts maximal runs of
    deleted lines, blank lines between them apart; deleted lines go with
    their line feed.

    Null ids come before others. Rows that share id and text are one document:
    they delete nothing in each other. Other columns are not looked at. Texts
    shorter than a run stay as they are. An empty table gives no rows.
    """
    run = window + gram - 1
    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                rows: list[tuple] = []
                keys = (block.column(x).to_pylist() for x in ("doc_id", "text_hash"))
                for doc_id, text_hash, text in zip(*keys, texts_of(block, "text"), strict=True):
                    hashes, _, lines = line_hashes(text)
                    for first, n in wordy_runs(lines, run - 1, least_words):
                        rows.append((int(gram_hashes(hashes[first : first + n], n)[0]), doc_id, text_hash, first, hashes[first : first + n].tolist(), n))
                    grams = gram_hashes(hashes, gram)
                    chosen = winnow(grams, window)
                    if not len(chosen):
                        continue
                    cuts = np.flatnonzero(np.diff(chosen)) + 1
                    for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(chosen)], strict=True):
                        # All runs of lines whose fingerprint is here: from the first to the last line of any.
                        around = hashes[first : end - 1 + run].tolist()
                        rows.append((int(grams[chosen[first]]), doc_id, text_hash, first, around, run))
                if rows:
                    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.int32()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                        ["print", "doc_id", "text_hash", "first", "around", "n"],
                    )

    places = staged(
        source.mapInArrow(select, "print long, doc_id long, text_hash long, first long, around array<long>, n int"), "places"
    )
    # A fingerprint that only one document's one place has cannot be part of a match.
    # Written before the join, like the first runs below: a join of plain shuffles can be
    # split where very many places share a key, one after a grouping cannot.
    repeated = staged(places.groupBy("print").agg(F.count("*").alias("times")).filter("times > 1").select("print"), "repeated")
    met = places.join(repeated, "print", "left_semi")
    # Both ways from the fingerprint: every run of lines that it stands for.
    runs = met.select(
        "doc_id",
        "text_hash",
        F.posexplode(
            F.transform(F.sequence(F.lit(1), F.size("around") - F.col("n") + 1), lambda i: F.slice("around", i, F.col("n")))
        ).alias("step", "lines"),
        "first",
    ).select("lines", F.struct("doc_id", "text_hash", (F.col("first") + F.col("step")).alias("line")).alias("at"))
    runs = staged(runs.distinct(), "runs")
    firsts = staged(
        runs.groupBy("lines").agg(F.min("at").alias("first_at"), F.count("*").alias("n")).filter("n > 1"), "firsts"
    )
    later = runs.join(firsts, "lines").filter(F.col("at") != F.col("first_at"))
    gone = F.sequence(F.col("at.line"), F.col("at.line") + F.size("lines") - 1)
    per_doc = later.groupBy("at.doc_id", "at.text_hash").agg(F.collect_list(gone).alias("later"))
    per_doc = staged(per_doc, "later")

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_lines", "n_removed", "n_runs", "kept_text"]
        kinds = [pa.int64()] * 4 + [pa.binary()]
        for batch in batches:
            for block in blocks(batch, "text"):
                rows = []
                ids, later = block.column("doc_id").to_pylist(), block.column("later").to_pylist()
                for doc_id, text, at in zip(ids, texts_of(block, "text"), later, strict=True):
                    lines = text.split(b"\n")
                    if not at:
                        rows.append((doc_id, len(lines), 0, 0, text))
                        continue
                    _, numbers, _ = line_hashes(text)
                    gone = np.unique(np.concatenate(at))
                    dropped = set(numbers[gone].tolist())
                    kept = b"\n".join([x for i, x in enumerate(lines) if i not in dropped])
                    rows.append((doc_id, len(lines), len(dropped), int((np.diff(gone) > 1).sum()) + 1, kept))
                arrays = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*arrays[:4], arrays[4].cast(pa.string())], names)

    same = source["doc_id"].eqNullSafe(per_doc["doc_id"]) & (source["text_hash"] == per_doc["text_hash"])
    # Lists of deleted lines grow with the documents, so the plan is the one for many of them.
    return (
        source.join(per_doc.hint("merge"), same, "left")
        .select(source["doc_id"], source["text"], "later")
        .mapInArrow(delete, "doc_id long, n_lines long, n_removed long, n_runs long, kept_text string")
    )
