import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chirpline.llm.repeats import anchors, merged, repeat_digests, running_least
from chirpline.llm.suffixes import common_prefixes, joined, suffix_array

from .cases import DOC_SCHEMA, found, no_docs, with_clashes, words


@given(st.lists(st.binary(max_size=30) | st.text("ab", max_size=40).map(str.encode), min_size=1, max_size=8), st.integers(1, 20))
@settings(max_examples=200, deadline=None)
def test_suffix_array_and_common_prefixes(strings, most):
    symbols, starts = joined(strings)
    order = suffix_array(symbols)
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
    got = common_prefixes(symbols, order, starts, most)
    for i in range(1, len(order)):
        a, b = symbols[order[i] :], symbols[order[i - 1] :]
        n = min(len(a), len(b), most)
        differ = np.flatnonzero(a[:n] != b[:n])
        assert got[i] == (differ[0] if len(differ) else n)


def test_equal_strings_have_equal_anchors():
    rng = random.Random(2)
    text = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(400)) * 3, np.uint8)
    got = anchors(text, 200)
    assert len(got) == len(text) - 199
    seen = {}
    for i, distance in enumerate(got.tolist()):
        assert 0 <= distance <= 200 - 32
        assert seen.setdefault(text[i : i + 200].tobytes(), distance) == distance
    assert running_least(np.array([3, 1, 2, 5, 4]), 3).tolist() == [1, 1, 2]


def test_merge_finds_strings_of_other_shards():
    digests = [bytes([i]) * 15 + b"\0" for i in (1, 2, 3, 2, 3, 9)]
    shards = np.array([1, 1, 1, 2, 3, 3])
    known = np.array([False, False, True, False, False, False])
    assert merged(shards, digests, known).tolist() == [False, True, False, True, True, False]
    assert merged(shards[:0], [], known[:0]).tolist() == []


def brute(rows, length):
    texts = [(x[1] or "").encode() for x in rows]
    strings = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for row, text in zip(rows, texts):
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            if strings[text[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((row[0], len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    base = [words(rng, rng.randint(0, 250)) for _ in range(30)]
    hot = words(rng, 90)
    texts: list[str | None] = [*base, *base[:6], base[7] + base[7], "xyz " * 300, "xyz " * 90, "a" * 900, "", None, " "]
    for text in base[10:25]:
        cut = rng.randrange(len(text) + 1)
        texts += [text[:cut] + "X" + text[cut:], words(rng, 9) + text[cut:] + words(rng, 9)]
    texts += [f"{words(rng, 9)} {hot} {words(rng, 9)}" for _ in range(40)]
    rows = [(i, x, "en", "s", 0) for i, x in enumerate(texts)]
    return [*rows, rows[8], rows[8], (None, base[9], "en", "s", 0), (0, words(rng, 80), "en", "s", 0)]


@pytest.mark.parametrize(("length", "shard_bytes"), [(400, 1 << 20), (200, 3000), (160, 1200)])
def test_repeats(spark, length, shard_bytes):
    rows = corpus(length)
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA).repartition(4))
    assert found(repeat_digests(docs, length=length, shard_bytes=shard_bytes)) == brute(rows, length)


def test_empty_table_and_short_length(spark):
    assert found(repeat_digests(no_docs(spark))) == []
    with pytest.raises(ValueError, match="at least"):
        repeat_digests(no_docs(spark), length=100)


def test_common_prefixes_of_the_first_suffixes_only():
    symbols, starts = joined([b"abcabc", b"bcab", b"abcab"])
    order = suffix_array(symbols)
    some = common_prefixes(symbols, order, starts, 9, np.array([2, 0, 3]))
    whole = common_prefixes(symbols, order, starts, 9)
    asked = np.isin(order, [0, 1, *(starts[2] + np.arange(3)).tolist()])
    assert some.tolist() == np.where(asked, whole, 0).tolist()


def passages(seed, n_words):
    """Documents of words of their own; every second pair shares a passage of so many words, at other places."""
    rng = random.Random(seed)
    own = lambda i, n: " ".join(f"{rng.getrandbits(32):08x}"[: rng.randint(3, 8)] + str(i) for _ in range(n))
    rows, planted = [], {}
    for pair in range(20):
        passage = own(f"p{pair}", n_words)
        for i in (2 * pair, 2 * pair + 1):
            parts = [own(i, rng.randint(80, 200)), passage if pair % 2 else own(i, n_words), own(i, rng.randint(80, 200))]
            rows.append((i, " ".join(parts), "en", "s", 0))
            if pair % 2:
                planted[i] = len(passage.encode())
    return rows, planted


@pytest.mark.parametrize("n_words", [51, 60, 120])
def test_planted_passages_are_caught_and_clean_documents_left_alone(spark, n_words):
    """Judged by ``n_removed``: a shared passage goes where it has 400 bytes, and nothing else does."""
    rows, planted = passages(n_words, n_words)
    got = {r.doc_id: r for r in repeat_digests(spark.createDataFrame(rows, DOC_SCHEMA).repartition(4), length=400).collect()}
    assert all(size >= 400 for size in planted.values()) or n_words == 51
    for doc_id, r in got.items():
        want = planted.get(doc_id, 0)
        # the passage, and the blanks on either side of it with what happens to be alike around them
        assert want + 2 <= r.n_removed <= want + 6 if r.n_removed else want + 2 < 400
        assert r.n_spans == (r.n_removed > 0)
        assert r.n_bytes == len(rows[doc_id][1].encode())
