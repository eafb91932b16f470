"""Quality by supervised subword embeddings.

A document is the average of learned vectors: one for each word, each
character n-gram of it and each pair of words in a row, found by hashing. A
softmax layer over the average tells the two labels apart. Vectors and layer
are trained by stochastic gradient descent in numpy on a bounded sample.
Afterwards every feature needs just the difference that its vector makes to
the two outputs, so scoring is a sum over the words of a text and its pairs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from chirpline.llm.common import blocks, text_or_empty, texts_of, unused
from chirpline.llm.sampling import fold, labelled_sample

FOLDS = 5
THRESHOLD = 0.3

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
GRAM = 3
MEMO_WORDS = 250_000
# Longer words are split, so that a text without white space has features like any other.
WORD_BYTES = 64


def word_features(word: bytes) -> list[int]:
    """Buckets of the word and of its character n-grams, edges marked."""
    crc = zlib.crc32
    out = [crc(word) % BUCKETS]
    for start in range(0, len(word), WORD_BYTES):
        marked = b"<" + word[start : start + WORD_BYTES] + b">"
        out += [crc(marked[i : i + GRAM], GRAM) % BUCKETS for i in range(len(marked) - GRAM + 1)]
    return out


def pair_features(crcs: np.ndarray) -> np.ndarray:
    """Buckets of words in a row, by pairs, out of the words' checksums."""
    h = crcs[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + crcs[1:].astype(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


@dataclass
class Model:
    """Each bucket's share in the log odds of label 1, and the log odds of a document without features."""

    share: np.ndarray
    bias: float


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their parts of its average."""
    words = text.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    ids: list[int] = []
    times: list[int] = []
    for word, n in Counter(words).items():
        found = word_features(word)
        ids += found
        times += [n] * len(found)
    pairs = pair_features(np.array([zlib.crc32(x) for x in words], dtype=np.uint32))
    buckets, inverse = np.unique(np.concatenate((np.array(ids), pairs)), return_inverse=True)
    parts = np.bincount(inverse, weights=np.concatenate((times, np.ones(len(pairs)))))
    return buckets, (parts / parts.sum()).astype(np.float32)


def train(
    sample: list[tuple[int, bytes]], counts: dict[int, int], size: int = 16, epochs: int = 12, rate: float = 0.7, seed: int = 7
) -> Model:
    """Gradient descent, one document at a time, over shuffled epochs with a falling rate.

    The sample may hold the classes in other proportions than ``counts``, all
    learning rows; the bias makes up for it. Without rows of both labels every
    score is the share of label 1, or one half.
    """
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, size)) - 0.5) / size).astype(np.float32)
    layer = np.zeros((size, 2), dtype=np.float32)
    seen = [sum(y == k for y, _ in sample) for k in (0, 1)]
    if not all(seen):
        odds = (counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(odds)))
    features = [(y, *document_features(text)) for y, text in sample]
    features = [x for x in features if len(x[1])]
    steps, done = epochs * len(features), 0
    for _ in range(epochs):
        for i in rng.permutation(len(features)):
            y, ids, parts = features[i]
            step = rate * (1 - done / steps)
            rows = vectors[ids]
            mean = parts @ rows
            out = np.exp(np.clip(mean @ layer, -30, 30))
            out /= out.sum()
            out[y] -= 1
            back = layer @ out
            layer -= step * np.outer(mean, out)
            # Scaled so that a document moves its average by the step, however many features share it.
            vectors[ids] = rows - (step / (parts @ parts) * parts)[:, None] * back[None, :]
            done += 1
    prior = np.log(counts[1] / counts[0]) - np.log(seen[1] / seen[0])
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(prior))


class Scorer:
    """Scores of whole texts, with a memo of words met before; emptied when full, it changes no result."""

    def __init__(self, model: Model):
        self.bias = model.bias
        self.share = model.share.astype(np.float64)
        self.shares = self.share.tolist()
        self.forget()

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        # of each word met: the sum of its shares, how many they are, its checksum
        self.known = [np.empty(0, np.float64), np.empty(0, np.float64), np.empty(0, np.uint32)]

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.memo)
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.forget()
            new = words
        if new:
            features = [word_features(x) for x in new]
            self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new)), strict=True))
            sums = [sum(map(self.shares.__getitem__, x)) for x in features]
            more = sums, [len(x) for x in features], [zlib.crc32(x) for x in new]
            self.known = [np.concatenate((x, np.array(y, x.dtype))) for x, y in zip(self.known, more, strict=True)]

    def scores(self, texts: list[bytes]) -> list[float]:
        split = [x.split() for x in texts]
        self.learn(set().union(*split))
        n = len(texts)
        of = np.repeat(np.arange(n), [len(x) for x in split])
        ids = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=len(of))
        sums, sizes, crcs = (x[ids] for x in self.known)
        whole = of[1:] == of[:-1]  # pairs within a text
        at, pairs = of[1:][whole], self.share[pair_features(crcs)[whole]]
        total = np.bincount(of, sums, n) + np.bincount(at, pairs, n)
        count = np.bincount(of, sizes, n) + np.bincount(at, minlength=n)
        mean = total / np.maximum(count, 1)
        return (1 / (1 + np.exp(-np.clip(mean + self.bias, -50, 50)))).tolist()


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1000, most_bytes: int = 1 << 16) -> Model:
    """Learns from labels of ids whose fold is not 0."""
    sample, counts = labelled_sample(docs, labels, "quality", fold(FOLDS) != 0, per_class, most_bytes)
    return train(sample, counts)


def _scored(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """The rows with a column ``name`` more: the score of ``text``."""
    model_of_all = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model_of_all.value)
        for batch in batches:
            for block in blocks(batch, "text"):
                found = pa.array(scorer.scores(texts_of(block, "text")), pa.float64())
                yield pa.RecordBatch.from_arrays([*block.columns, found], [*block.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, in one pass.

    Empty, blank and null texts get the score of a document without features.
    A text of any length is scored whole, and long words in pieces. A null
    ``doc_id`` is not held out. Rows that repeat have their own rows; other
    columns are not looked at. An empty table gives no rows.
    """
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return _scored(texts, model, "score").select(
        "doc_id",
        F.coalesce(fold(FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose predicted quality is 1, with the columns of ``docs``; none is changed.

    Null and empty texts, repeated rows and an empty table are as in ``score``;
    columns may have any names.
    """
    name = unused(docs, "score")
    return _scored(docs, fit(docs, labels), name).filter(F.col(name) >= THRESHOLD).drop(name)
