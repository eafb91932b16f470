"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole. Byte-level tokens spell the text out,
so their spans are running sums of their lengths. Sections are spans of the
same text; an interval join of both sorted lists tells which sections a token
touches, and a rule gives a token that crosses a boundary to one of them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import blocks, text_or_empty, texts_of

# Who gets a token that crosses a boundary.
MOST = "most"  # the section with most of its bytes, the earlier one if equal
FIRST = "first"  # the section of its first byte
LAST = "last"  # the section of its last byte
RULES = (MOST, FIRST, LAST)


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str):
    """The encoding of a ``.tiktoken`` file, and the byte length of each of its tokens."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("tokens", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def line_starts(text: bytes) -> np.ndarray:
    """Where lines begin; a line keeps its line feed, and a last line without text is none."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.concatenate(([0], ends[ends < len(text)])).astype(np.int64)


def attribute(token_ends: np.ndarray, starts: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Per section, the tokens it gets and how many of these also touch others.

    Tokens tile the bytes 0 to ``size``, and so do the sections, of which some
    may be empty.
    """
    token_starts = np.concatenate(([0], token_ends[:-1])) if len(token_ends) else token_ends
    # A byte's section is the last that starts at or before it; empty ones before it share that start.
    first = np.searchsorted(starts, token_starts, side="right") - 1
    last = np.searchsorted(starts, token_ends - 1, side="right") - 1
    if rule == FIRST:
        given = first
    elif rule == LAST:
        given = last
    else:
        given = first.copy()
        ends = np.concatenate((starts[1:], [size]))
        for i in np.flatnonzero(first != last):
            parts = np.arange(first[i], last[i] + 1)
            held = np.minimum(ends[parts], token_ends[i]) - np.maximum(starts[parts], token_starts[i])
            given[i] = parts[held.argmax()]
    return (
        np.bincount(given, minlength=len(starts)),
        np.bincount(given[first != last], minlength=len(starts)),
    )


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    fields: list[str] | None = None,
    between: str = "\n",
    rule: str = MOST,
) -> DataFrame:
    """One row per section: ``doc_id, section, start_char, end_char, n_tokens, n_crossing``.

    Sections are the lines of ``text``, each with its line feed, numbered from
    0. With ``fields`` the document is these columns joined by ``between``,
    and each field, with the separator after it, is a section. ``n_tokens`` is
    the tokens the section gets under ``rule``, and ``n_crossing`` how many of
    these touch other sections too, so ``n_tokens`` of a document add up to
    its tokens. Spans are in characters of the whole document.

    A null or empty text has one section without tokens; a null field is an
    empty one. Rows that repeat have rows of their own; other columns are not
    looked at. An empty table gives no rows. One pass without a shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    columns: list[Column] = [text_or_empty(x).alias(f"f{i}") for i, x in enumerate(fields or ["text"])]
    names = [f"f{i}" for i in range(len(columns))]
    glue = between.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = encoder_of(tokenizer_path, pattern)
        for batch in batches:
            for block in blocks(batch, "f0"):
                out: list[list[np.ndarray]] = []
                for parts in zip(*(texts_of(block, x) for x in names), strict=True):
                    text = glue.join(parts)
                    if fields:
                        starts = np.cumsum([0, *(len(x) + len(glue) for x in parts[:-1])])
                    else:
                        starts = line_starts(text)
                    token_ends = np.cumsum(sizes[np.array(encoding.encode_ordinary(text.decode()), dtype=np.int64)])
                    n_tokens, n_crossing = attribute(token_ends, starts, len(text), rule)
                    # Bytes that begin a character, counted up to each place.
                    chars = np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)
                    char_at = np.concatenate(([0], chars))
                    ends = np.concatenate((starts[1:], [len(text)]))
                    out.append([np.arange(len(starts)), char_at[starts], char_at[ends], n_tokens, n_crossing])
                lengths = [len(x[0]) for x in out]
                ids = block.column("doc_id").take(pa.array(np.repeat(np.arange(len(out)), lengths)))
                values = [pa.array(np.concatenate([x[i] for x in out]), pa.int64()) for i in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [ids, *values], ["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing"]
                )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), *columns).mapInArrow(
        run, "doc_id long, section long, start_char long, end_char long, n_tokens long, n_crossing long"
    )
