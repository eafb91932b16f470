"""Toxicity by a convolutional text classifier.

A word's vector is the sum of learned vectors found by hashing the word, its
beginnings and its end. After a run of several words without white space come
pieces of it, which stand for the words that may begin within them. Filters of several widths run over the words of a
text, each keeps its largest value (max pooling over time), and a logistic
layer over these gives the raw score. Everything is trained in numpy on a
bounded sample of whole texts. For each language, as function words in the
text show it, a threshold is calibrated on rows kept out of the training, and
scores are bent so that this threshold lies at the same place in all languages.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import blocks, text_or_empty, texts_of
from chirpline.llm.sampling import fold, labelled_sample

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3

WIDTHS = (1, 2, 3)
FILTERS = 8
SIZE = 16
# Features of the model: the hashed words and word parts of at least MIN_DOCS sample documents.
MOST_FEATURES = 1 << 16
MIN_DOCS = 5
STARTS = (4, 5, 6, 7)
MEMO_WORDS = 150_000
# Words of more characters are runs of several. Scripts that have no white space between words (Thai, Han, kana
# and others from NO_SPACES on) write runs of any length, and words of few characters.
WORD_CHARS = 24
LEAST, LEAST_NO_SPACES, MOST = 4, 2, max(STARTS)
NO_SPACES = "\u0e00"
# Places of a piece at which words may begin, and what marks a piece.
STEP = 4
MARK = "\0"

# A document this near its label teaches nothing.
SURE = 0.01
# F1 that a threshold may fall short of the best, so that single rows don't decide it.
NEARLY = 0.02

WORDS = re.compile(r"[^\W_]+")

# Function words that tell languages apart.
FUNCTION_WORDS = {
    "en": ("the", "and", "of", "to", "is", "was", "that", "for", "with", "it"),
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "mit", "zu", "auf"),
    "fr": ("le", "les", "et", "est", "une", "dans", "pour", "avec", "pas", "du"),
    "es": ("el", "los", "las", "y", "una", "con", "para", "por", "del", "es"),
}
LANGUAGES = ("other", *FUNCTION_WORDS)
LANGUAGE_OF = {word: i + 1 for i, words in enumerate(FUNCTION_WORDS.values()) for word in words}


def pieces(word: str) -> list[str]:
    """Pieces of a run of several words: each place of it begins in one, with MOST characters if there are."""
    no_spaces = max(word) >= NO_SPACES
    if len(word) <= (LEAST_NO_SPACES if no_spaces else WORD_CHARS):
        return []
    least = LEAST_NO_SPACES if no_spaces else LEAST
    return [MARK + word[i : i + STEP + MOST - 1] for i in range(0, len(word) - least + 1, STEP)]


def words_of(text: bytes) -> list[str]:
    """The words, each with its pieces behind it."""
    words = WORDS.findall(text.decode("utf-8", "replace").lower())
    out: list[str] = []
    for word in words:
        out.append(word)
        if len(word) > WORD_CHARS or not word.isascii():
            out += pieces(word)
    return out


def word_features(word: str) -> list[int]:
    """Hashes of the word, its beginnings and its end; of a piece those of words, and of beginnings, that start in it."""
    crc = zlib.crc32
    if word[0] != MARK:
        out = [crc(word.encode())]
        out += [crc(word[:n].encode(), n) for n in STARTS if len(word) > n]
        if len(word) > 4:
            out.append(crc(word[-4:].encode(), 99))
        return out
    out = []
    for i in range(1, min(STEP + 1, len(word))):
        for n in range(LEAST_NO_SPACES if word[i] >= NO_SPACES else LEAST, min(MOST, len(word) - i) + 1):
            part = word[i : i + n].encode()
            out.append(crc(part))
            if n in STARTS:
                out.append(crc(part, n))
    return list(dict.fromkeys(out))


TAPS = sum(WIDTHS) * FILTERS


def tap_slices() -> list[tuple[int, int]]:
    """Width and first column, among all taps, of each filter bank."""
    out, at = [], 0
    for width in WIDTHS:
        out.append((width, at))
        at += width * FILTERS
    return out


@dataclass
class Model:
    """Vectors by feature, filter taps, biases, the logistic layer and each language's threshold.

    Row 0 of the vectors is zero.
    """

    rows: dict[int, int]
    vectors: np.ndarray
    taps: np.ndarray
    bias: np.ndarray
    layer: np.ndarray
    offset: float
    thresholds: np.ndarray

    def indices(self, word: str) -> list[int]:
        """The rows of the word's features; row 0 if it has none."""
        return [r for r in (self.rows.get(x, 0) for x in word_features(word)) if r] or [0]


def pooled(projected: np.ndarray, starts: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Each filter's largest value per document, not under 0.

    ``projected`` has the taps' values of all words of some documents. Before
    each document, and after the last, stand max(WIDTHS) - 1 rows of zeros, so
    that windows reach over its edges but never into another document.
    ``starts`` are the documents' first windows.
    """
    out = []
    last = len(projected) - max(WIDTHS) + 1
    for width, at in tap_slices():
        value = projected[:last, at : at + FILTERS].copy()
        for k in range(1, width):
            value += projected[k : last + k, at + k * FILTERS : at + (k + 1) * FILTERS]
        out.append(np.maximum.reduceat(value, starts, axis=0))
    return np.maximum(np.concatenate(out, axis=1) + bias, 0)


PAD = max(WIDTHS) - 1


class Net:
    """The network in training; steps by AdaGrad, one document at a time."""

    def __init__(self, features: int, rng: np.random.Generator):
        self.vectors = (rng.standard_normal((features + 1, SIZE)) * 0.05).astype(np.float32)
        self.vectors[0] = 0
        self.taps = (rng.standard_normal((SIZE, TAPS)) * 0.3).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.layer = (rng.standard_normal(len(WIDTHS) * FILTERS) * 0.3).astype(np.float32)
        self.offset = np.zeros(1, np.float32)
        self.past = {name: np.full_like(getattr(self, name), 1e-6) for name in ("vectors", "taps", "bias", "layer", "offset")}

    def _step(self, name: str, grad: np.ndarray, rate: float, at=slice(None)) -> None:
        past = self.past[name]
        past[at] += grad * grad
        getattr(self, name)[at] -= rate * grad / np.sqrt(past[at])

    def learn(self, index: np.ndarray, starts: np.ndarray, y: int, weight: float, rate: float) -> None:
        """``index``: the feature rows of each word, padding included, which begin at ``starts``."""
        words = np.add.reduceat(self.vectors[index], starts, axis=0)
        projected = words @ self.taps
        last = len(projected) - PAD
        best, value = [], []
        for width, at in tap_slices():
            sums = projected[:last, at : at + FILTERS].copy()
            for k in range(1, width):
                sums += projected[k : last + k, at + k * FILTERS : at + (k + 1) * FILTERS]
            top = sums.argmax(axis=0)
            best.append(top)
            value.append(sums[top, np.arange(FILTERS)])
        hidden = np.maximum(np.concatenate(value) + self.bias, 0)
        score = 1 / (1 + np.exp(-np.clip(hidden @ self.layer + self.offset[0], -30, 30)))
        if abs(score - y) < SURE:
            return
        error = np.float32(weight * (score - y))
        back = error * self.layer * (hidden > 0)
        self._step("layer", error * hidden, rate)
        self._step("offset", np.array([error], np.float32), rate)
        if not back.any():
            return
        # Each tap of each filter has seen one word: the one under it where the filter was largest.
        at_word = np.concatenate([best[i] + k for i, (width, _) in enumerate(tap_slices()) for k in range(width)])
        banks = [(back[i * FILTERS : (i + 1) * FILTERS], width) for i, width in enumerate(WIDTHS)]
        each = np.concatenate([bank for bank, width in banks for _ in range(width)])
        add = each[:, None] * self.taps.T
        self._step("taps", (each[:, None] * words[at_word]).T, rate)
        self._step("bias", back, rate)
        lengths = np.diff(starts, append=len(index))[at_word]
        ends = np.cumsum(lengths)
        features = index[np.arange(ends[-1]) + np.repeat(starts[at_word] - ends + lengths, lengths)]
        rows, place = np.unique(features, return_inverse=True)
        grad = np.zeros((len(rows), SIZE), np.float32)
        np.add.at(grad, place, np.repeat(add, lengths, axis=0))
        if rows[0] == 0:
            rows, grad = rows[1:], grad[1:]
        self._step("vectors", grad, rate, rows)


def best_threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """The middle of the thresholds whose F1 is the best, or nearly."""
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], y[order].cumsum()
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
    near = np.flatnonzero(f1 >= f1.max() - NEARLY)
    below = s[near[-1] + 1] if near[-1] + 1 < len(s) else 0.0
    return float((s[near[0]] + below) / 2)


def train(
    sample: list[tuple[int, bytes]], counts: dict[int, int], epochs: int = 6, rate: float = 0.05, seed: int = 11
) -> Model:
    """Trains on the whole sample, with thresholds from a model of four fifths of it that scored the rest.

    A class weighs as much as its share of all learning rows (``counts``),
    evened out by half. A language with under 20 calibration rows of either
    label takes the threshold of all rows. Without rows of both labels, scores
    are the share of label 1.
    """
    rng = np.random.default_rng(seed)
    split = [(y, words_of(text)) for y, text in sample]
    seen = [sum(y == k for y, _ in sample) for k in (0, 1)]
    used: Counter[int] = Counter()
    for _, words in split:
        used.update({x for word in set(words) for x in word_features(word)})
    common = sorted(((n, x) for x, n in used.items() if n >= MIN_DOCS), key=lambda v: (-v[0], v[1]))[:MOST_FEATURES]
    rows = {x: i + 1 for i, (_, x) in enumerate(common)}

    def fresh(net: Net, thresholds: np.ndarray) -> Model:
        return Model(rows, net.vectors, net.taps, net.bias, net.layer, float(net.offset[0]), thresholds)

    model = fresh(Net(len(rows), rng), np.full(len(LANGUAGES), THRESHOLD))
    if not all(seen):
        model.layer = np.zeros_like(model.layer)
        model.offset = float(np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)))
        return model

    memo: dict[str, list[int]] = {}
    blank = [[0]] * PAD
    inputs = []
    for y, words in split:
        for word in words:
            if word not in memo:
                memo[word] = model.indices(word)
        each = [*blank, *(memo[x] for x in words), *blank]
        starts = np.cumsum([0, *map(len, each[:-1])], dtype=np.int32)
        inputs.append((np.fromiter(chain.from_iterable(each), np.int32), starts, y))
    weight = [(counts[k] / sum(counts.values()) * len(sample) / seen[k]) ** 0.5 for k in (0, 1)]

    def learned(some: np.ndarray) -> Net:
        net = Net(len(rows), np.random.default_rng(seed))
        for epoch in range(epochs):
            for i in rng.permutation(some):
                net.learn(*inputs[i], weight[inputs[i][2]], rate * (1 - epoch / epochs))
        return net

    order = rng.permutation(len(inputs))
    kept_out = order[: len(order) // 5]
    thresholds = model.thresholds
    scorer = Scorer(fresh(learned(order[len(kept_out) :]), thresholds))
    raw, languages = scorer.raw([sample[i][1] for i in kept_out])
    y = np.array([sample[i][0] for i in kept_out])
    if 0 < y.sum() < len(y):
        thresholds[:] = best_threshold(raw, y)
        for language in range(len(LANGUAGES)):
            own = languages == language
            if min(y[own].sum(), (1 - y[own]).sum()) >= 20:
                thresholds[language] = best_threshold(raw[own], y[own])
    return fresh(learned(order), np.clip(thresholds, 0.01, 0.99))


class Scorer:
    """Scores of whole texts, with a memo of words met before; emptied when full, it changes no result."""

    def __init__(self, model: Model):
        self.model = model
        # What a feature adds to each tap, so that a word's values are sums of rows.
        self.adds = model.vectors @ model.taps
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.values = np.zeros((1 << 12, TAPS), np.float32)
        self.language = np.zeros(1 << 12, np.int64)

    def learn(self, words: list[str]) -> None:
        first = len(self.memo) + 1  # row 0 is padding
        while first + len(words) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
            self.language = np.concatenate([self.language, np.zeros_like(self.language)])
        self.memo.update(zip(words, range(first, first + len(words)), strict=True))
        each = [self.model.indices(x) for x in words]
        index = np.fromiter(chain.from_iterable(each), np.int32)
        lengths = np.fromiter(map(len, each), np.int64, len(each))
        starts = np.cumsum(lengths) - lengths
        value = np.zeros((len(words), TAPS), np.float32)
        for column in range(lengths.max()):
            some = np.flatnonzero(lengths > column)
            value[some] += self.adds[index[starts[some] + column]]
        self.values[first : first + len(words)] = value
        self.language[first : first + len(words)] = [LANGUAGE_OF.get(x, 0) for x in words]

    def raw(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores before calibration, and the languages."""
        split = [words_of(x) for x in texts]
        wanted: set[str] = set().union(*split)
        new = wanted.difference(self.memo)
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.forget()
            new = wanted
        if new:
            self.learn(sorted(new))
        find = self.memo.__getitem__
        ids, starts = [], []
        for words in split:
            ids += [0] * PAD
            # The window that begins within the padding reaches the first word.
            starts.append(len(ids) - PAD)
            ids += map(find, words)
        ids += [0] * (2 * PAD)
        at = np.array(ids, dtype=np.int64)
        hidden = pooled(self.values[at], np.array(starts), self.model.bias)
        raw = 1 / (1 + np.exp(-np.clip(hidden @ self.model.layer + self.model.offset, -50, 50)))
        ends = np.array([*starts[1:], len(at)])
        doc = np.repeat(np.arange(len(split)), ends - np.array(starts))
        votes = np.bincount(doc * len(LANGUAGES) + self.language[at], minlength=len(split) * len(LANGUAGES))
        votes = votes.reshape(len(split), len(LANGUAGES))
        votes[:, 0] = 0
        return raw.astype(np.float64), votes.argmax(axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Bent so that the language's threshold lies at THRESHOLD."""
        raw, language = self.raw(texts)
        limit = self.model.thresholds[language]
        low = THRESHOLD * raw / limit
        high = THRESHOLD + (1 - THRESHOLD) * (raw - limit) / (1 - limit)
        return np.clip(np.where(raw < limit, low, high), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, most_bytes: int = 1 << 15) -> Model:
    """Learns from labels of ids whose fold is not HELD_OUT."""
    sample, counts = labelled_sample(docs, labels, "toxic", fold(FOLDS) != HELD_OUT, per_class, most_bytes)
    return train(sample, counts)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, in one pass.

    Empty, blank and null texts get the score of a text without words. A null
    ``doc_id`` is not held out. Rows that repeat have their own rows; other
    columns are not looked at.
    """
    model_of_all = docs.sparkSession.sparkContext.broadcast(model)  # MOST_FEATURES vectors at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model_of_all.value)
        for batch in batches:
            for block in blocks(batch, "text"):
                found = pa.array(scorer.scores(texts_of(block, "text")), pa.float64())
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), found], ["doc_id", "score"])

    scored = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, score double"
    )
    return scored.select(
        "doc_id",
        F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
