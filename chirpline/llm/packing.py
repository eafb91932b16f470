"""Packing by power-of-two decomposition.

Each document is cut into pieces whose lengths are powers of two: as many of
the longest length as fit, then the binary digits of what is left. A piece is
a sequence of its own, so sequences never cross documents, and sequences of
equal length form a bucket from which batches without padding are drawn.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from chirpline.llm.common import blocks, text_or_empty

# Stands between words that are encoded together; words that hold it go alone.
MARK = b"\x01"
MEMO_WORDS = 400_000
MEMO_PARTS = 100_000
MEMO_WORD_BYTES = 64
WORDS_PER_CALL = 1_000
TEXT_BYTES = 4 << 20
# Letters with punctuation around them: up to three parts that the tokenizer splits
# before it merges. Lines that are anything else go into the last group.
PLAIN = re.compile(r"^(?:([!-&(-/:-@\[-`{-~]*)([a-zß-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)|(.*))$", re.M)

# Bits of a sequence id: the bucket, the task that cut the piece, the piece's place there.
TASK_BITS, PLACE_BITS = 24, 34


class Memo:
    """Values of the keys used last, at least ``size`` and about twice as many at most."""

    def __init__(self, size: int, learn: Callable[[list], list]):
        self.size, self.learn = size, learn
        self.now: dict = {}
        self.before: dict = {}

    def of(self, keys: list) -> list:
        """The values of keys that differ from each other."""
        if len(self.now) > self.size:
            self.before, self.now = self.now, {}
        now, before = self.now, self.before
        values = list(map(now.get, keys))
        new = []
        for i in [i for i, value in enumerate(values) if value is None]:
            values[i] = before.get(keys[i])
            if values[i] is None:
                new.append(i)
            else:
                now[keys[i]] = values[i]
        for i, value in zip(new, self.learn([keys[i] for i in new]) if new else (), strict=True):
            values[i] = now[keys[i]] = value
        return values


class WordEncoder:
    """Token ids of whole texts by a lower-casing tokenizer that drops white space.

    Such a tokenizer never looks across white space, nor from letters to
    punctuation, so a text's ids are those of its words one after the other,
    and a plain word's ids those of its parts. Words and parts met before come
    from memos, which change no result.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words = Memo(MEMO_WORDS, self._learn_words)
        self.parts = Memo(MEMO_PARTS, lambda parts: list(map(self._learn_part, parts)))
        self.mark = self._encode([MARK.decode()])[0]
        if len(self.mark) != 1:
            raise ValueError(f"{path} has no single id for the mark between words")
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]

    def _learn_part(self, part: str) -> bytes:
        """Ids of a part, which is merged as it stands; letters beyond ASCII are spelt in the tokenizer's byte letters first."""
        if not part:
            return b""
        if not part.isascii():
            part = self.bytes_of.pre_tokenize_str(part)[0][0]
        return array("I", [x.id for x in self.model.tokenize(part)]).tobytes()

    def _learn_odd(self, words: list[bytes]) -> dict[bytes, bytes]:
        alone = [x for x in words if MARK in x or len(x) > MEMO_WORD_BYTES]
        encoded = self._encode([x.decode() for x in alone])
        out = {word: ids.tobytes() for word, ids in zip(alone, encoded, strict=True)}
        rest = [x for x in words if x not in out]
        for i in range(0, len(rest), WORDS_PER_CALL):
            group = rest[i : i + WORDS_PER_CALL]
            ids = self._encode([(b" " + MARK + b" ").join(group).decode()])[0]
            cuts = np.flatnonzero(ids == self.mark[0])
            starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            out.update((word, ids[a:b].tobytes()) for word, a, b in zip(group, starts, ends, strict=True))
        return out

    def _learn_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words, in their order; none has white space of the ASCII range."""
        text = b"\n".join(words)
        special = [x for x in self.special if x in text]
        found = PLAIN.findall(text.decode().lower())
        parts = list({x for groups in found for x in groups[:3]})
        known = dict(zip(parts, self.parts.of(parts), strict=True))
        out = [known[head] + known[letters] + known[tail] for head, letters, tail, _ in found]
        odd = [
            i
            for i, groups in enumerate(found)
            if groups[3] or len(words[i]) > MEMO_WORD_BYTES or (special and any(x in words[i] for x in special))
        ]
        learned = self._learn_odd([words[i] for i in odd])
        for i in odd:
            out[i] = learned[words[i]]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, as unsigned 32-bit numbers, and where each text ends."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        spelt = self.words.of(words)  # white space at the edges of a text leaves an empty word, without ids
        sizes = np.fromiter(map(len, spelt), np.int64, len(spelt)) // 4
        ids = np.frombuffer(b"".join(spelt), dtype="<u4")
        codes = coded.indices.to_numpy()
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        # A block's ids are few enough for 32-bit places, unless one text alone is huge.
        kind = np.int32 if len(ids) + (ends[-1] if len(ends) else 0) < 1 << 31 else np.int64
        place = np.repeat(((np.cumsum(sizes) - sizes)[codes] - (ends - lengths)).astype(kind), lengths)
        place += np.arange(len(place), dtype=kind)
        flat = ids[place]
        last_word = np.cumsum(pc.list_value_length(split).to_numpy())
        return flat, np.concatenate(([0], ends))[last_word]


@lru_cache(maxsize=2)
def encoder_of(path: str) -> WordEncoder:
    """One encoder for all tasks that a Python worker runs."""
    return WordEncoder(path)


def piece_lengths(total: int, longest: int) -> list[int]:
    """The longest length as often as it fits, then the set bits of the rest, longest first."""
    whole, rest = divmod(total, longest)
    return [longest] * whole + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    longest: int = 2048,
    end_id: int = 1,
    with_ids: bool = True,
    encoder: Callable[[str], WordEncoder] = encoder_of,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket`` and, if asked for, ``ids``.

    ``longest`` must be a power of two. A null or empty text has ``end_id``
    alone: one piece of length 1. Rows that repeat, or share a ``doc_id``, are
    documents of their own; a null ``doc_id`` stays null; other columns are
    not looked at. An empty table gives no rows.

    The work is one pass without a shuffle, and a document is all that a task
    holds beyond a block of texts. ``sequence_id`` is bucket, task and place in
    the task, so ids are unique without a count over all pieces, and a task
    that runs again gives the same ones. ``offset`` is 0, as a sequence is one
    piece. Write with ``partitionBy("bucket")`` for a folder per length.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int"
        + ", ids array<int>" * with_ids
    )
    top = longest.bit_length() - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        task = TaskContext.get().partitionId()
        if task >> TASK_BITS:
            raise ValueError(f"more than {1 << TASK_BITS} tasks: read larger splits")
        places = [0] * (top + 1)
        for batch in batches:
            for block in blocks(batch, "text", TEXT_BYTES):
                flat, ends = encode(block.column("text"))
                flat = np.insert(flat, ends, end_id)
                rows: list[tuple] = []
                begin = 0
                ends = (ends + np.arange(1, len(ends) + 1)).tolist()
                for doc_id, end in zip(block.column("doc_id").to_pylist(), ends, strict=True):
                    start, total = begin, end - begin
                    for length in piece_lengths(total, longest):
                        bucket = length.bit_length() - 1
                        sequence = (top - bucket) << (TASK_BITS + PLACE_BITS) | task << PLACE_BITS | places[bucket]
                        crc = zlib.crc32(flat[start : start + length])
                        rows.append((doc_id, start - begin, length, crc, total, sequence, 0, bucket))
                        places[bucket] += 1
                        start += length
                    begin = end
                kinds = [pa.int64()] * 7 + [pa.int32()]
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"]
                if with_ids:
                    cuts = np.cumsum([0, *(row[2] for row in rows)])
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat.view("<i4"))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(cut, schema)
