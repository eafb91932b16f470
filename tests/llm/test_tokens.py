import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from chirpline.llm.tokens import FIRST, LAST, MOST, RULES, attribute, line_starts, token_counts

from .cases import found, no_docs, odd_docs, odd_rows, with_clashes

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain(encoding, text, starts, rule):
    """Goes through every byte of every token."""
    data = text.encode()
    section_of = [max(i for i, s in enumerate(starts) if s <= b) for b in range(len(data))]
    counts, crossing, at = [0] * len(starts), [0] * len(starts), 0
    for token in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(token))
        touched = section_of[at : at + size]
        at += size
        best = max(sorted(set(touched)), key=touched.count)
        given_to = {MOST: best, FIRST: touched[0], LAST: touched[-1]}[rule]
        counts[given_to] += 1
        crossing[given_to] += len(set(touched)) > 1
    return counts, crossing


@pytest.mark.parametrize("rule", RULES)
def test_lines(spark, encoding, rule):
    want = []
    for doc_id, text, *_ in odd_rows():
        text = text or ""
        starts = line_starts(text.encode()).tolist()
        chars = [len(text.encode()[:s].decode()) for s in [*starts, len(text.encode())]]
        counts, crossing = plain(encoding, text, starts, rule)
        want += [(doc_id, i, chars[i], chars[i + 1], counts[i], crossing[i]) for i in range(len(starts))]
    got = token_counts(with_clashes(odd_docs(spark)), PATH, PATTERN, rule=rule)
    assert found(got) == sorted(want, key=repr)


def test_fields_are_encoded_together(spark, encoding):
    rows = [(1, "Hello wor", "ld there", None), (2, None, None, None), (3, "é", "", "漢字 text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = token_counts(docs, PATH, PATTERN, fields=["text", "lang", "source"], between="")
    want = []
    for doc_id, *fields in rows:
        parts = [(x or "").encode() for x in fields]
        starts = [0, len(parts[0]), len(parts[0]) + len(parts[1])]
        text = b"".join(parts).decode()
        chars = [len(text.encode()[:s].decode()) for s in [*starts, len(text.encode())]]
        counts, crossing = plain(encoding, text, starts, MOST)
        want += [(doc_id, i, chars[i], chars[i + 1], counts[i], crossing[i]) for i in range(3)]
    assert found(got) == sorted(want, key=repr)
    assert any(x[5] for x in want)


@given(st.lists(st.integers(1, 9), max_size=12), st.lists(st.integers(0, 40), max_size=6), st.sampled_from(RULES))
@settings(max_examples=300, deadline=None)
def test_every_token_goes_to_one_section(sizes, starts, rule):
    total = sum(sizes)
    starts = np.array(sorted({0, *(s for s in starts if s <= total)}))
    counts, crossing = attribute(np.cumsum(sizes).astype(np.int64), starts, total, rule)
    assert counts.sum() == len(sizes)
    assert (crossing <= counts).all()
    section_of = np.searchsorted(starts, np.arange(total), side="right") - 1
    ends = np.cumsum(sizes)
    assert crossing.sum() == sum(section_of[e - n] != section_of[e - 1] for n, e in zip(sizes, ends))


def test_empty_table_and_unknown_rule(spark):
    assert found(token_counts(no_docs(spark), PATH, PATTERN)) == []
    with pytest.raises(ValueError, match="rule"):
        token_counts(no_docs(spark), PATH, PATTERN, rule="half")
