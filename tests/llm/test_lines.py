import random
import re

import numpy as np
import pytest

from chirpline.llm.lines import line_dedup, winnow, wordy_runs

from .cases import DOC_SCHEMA, found, no_docs, odd_docs, odd_rows, with_clashes

SPACE = " \t\n\r\x0b\x0c"


def brute(rows, run, least_words=50):
    seen, out = {}, []
    docs = sorted({(x[0] if x[0] is not None else -(10**9), x[1] or "") for x in rows})
    # Of rows with one id, the order is that of a hash of the text: such ids must not share lines here.
    removed = {}
    for doc_id, text in docs:
        lines = [x.strip(SPACE) for x in text.split("\n")]
        kept = [i for i, x in enumerate(lines) if x]
        gone = set()
        for n in range(1, run + 1):
            for k in range(len(kept) - n + 1):
                what = tuple(lines[i] for i in kept[k : k + n])
                if n < run and sum(len(re.findall("[^ \t-\r]+", x)) for x in what) < least_words:
                    continue
                if what in seen:
                    gone |= set(range(k, k + n))
                else:
                    seen[what] = doc_id
        removed[doc_id, text] = ({kept[k] for k in gone}, sum(k - 1 not in gone for k in gone))
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        gone, runs = removed[doc_id if doc_id is not None else -(10**9), text or ""]
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc_id, len(lines), len(gone), runs, kept))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    lines = [f"line {i}" for i in range(40)] + ["", "  ", "common"]
    texts = []
    for _ in range(60):
        text = [rng.choice(lines) for _ in range(rng.randint(0, 12))]
        if texts and rng.random() < 0.5:
            other = rng.choice(texts).split("\n")
            a = rng.randrange(len(other))
            text[rng.randrange(len(text) + 1) :] = [f" {x}\t" for x in other[a : a + rng.randint(1, 9)]]
        texts.append("\n".join(text))
    texts += ["a\n" * 20, "common\ncommon\ncommon\ncommon", None, ""]
    return [(i, x, "en", "s", 0) for i, x in enumerate(texts)]


@pytest.mark.parametrize(("gram", "window", "least_words"), [(2, 2, 50), (2, 2, 3), (1, 1, 50), (3, 4, 50), (3, 4, 7)])
def test_line_dedup(spark, gram, window, least_words):
    rows = corpus(gram)
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA).repartition(4))
    assert found(line_dedup(docs, gram, window, least_words)) == brute(rows, gram + window - 1, least_words)


def test_paragraphs_in_one_or_two_lines_go(spark):
    """Ten documents share a line of 120 words, five of them two such lines in a row; short lines stay."""
    rng = random.Random(4)
    shared = [" ".join(f"w{rng.random()}" for _ in range(120)) for _ in range(2)]
    rows = []
    for i in range(10):
        own = [f"own {i} {k}" for k in range(2)]
        rows.append((i, "\n".join([own[0], *shared[: 1 + i % 2], own[1], "short line", ""]), "en", "s", 0))
    got = line_dedup(spark.createDataFrame(rows, DOC_SCHEMA)).collect()
    assert sum(r.n_removed for r in got) == 9 + 4
    assert all(f"own {r.doc_id} 0" in r.kept_text and "short line" in r.kept_text for r in got)
    assert found(line_dedup(spark.createDataFrame(rows, DOC_SCHEMA))) == brute(rows, 3)


def test_runs_with_many_words():
    lines = [b"a " * 30, b"b", b"c " * 49, b"d " * 50]
    assert wordy_runs(lines, 2, 50) == [(3, 1), (1, 2), (2, 2)]
    assert wordy_runs([], 2, 50) == []


def test_odd_rows(spark):
    assert found(line_dedup(odd_docs(spark))) == brute(odd_rows(), 3)
    assert found(line_dedup(no_docs(spark))) == []


def test_rows_that_repeat_are_one_document(spark):
    rows = [(1, "a\nb\nc", "en", "s", 5)] * 2 + [(2, "a\nb\nc", "en", "s", 5)]
    got = found(line_dedup(spark.createDataFrame(rows, DOC_SCHEMA)))
    assert got == [(1, 3, 0, 0, "a\nb\nc")] * 2 + [(2, 3, 3, 1, "")]


def test_windows_minima():
    assert winnow(np.array([5, 3, 3, 9, 1]), 3).tolist() == [2, 2, 4]
    assert winnow(np.array([5]), 3).tolist() == []
