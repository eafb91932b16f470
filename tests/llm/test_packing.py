import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chirpline.llm.packing import Memo, WordEncoder, pack, piece_lengths

from .cases import found, no_docs, odd_docs, odd_rows, with_clashes

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(PATH)


def ids_of(encoder, texts):
    flat, ends = encoder.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(flat, ends[:-1])] if texts else []


@given(st.lists(st.text(alphabet=st.sampled_from("aBéÉßẞΣςİı'’1٣.!-_|<> \n\t\x0b\x0c\x1c\x85 ́漢😀ﬁK\x01") | st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=5))
@settings(max_examples=300, deadline=None)
def test_words_have_the_ids_of_the_whole_text(texts):
    encoder = test_words_have_the_ids_of_the_whole_text.encoder
    want = [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(encoder, texts) == want


test_words_have_the_ids_of_the_whole_text.encoder = WordEncoder(PATH)


def test_special_tokens_and_long_words(encoder):
    texts = ["<|endoftext|>", "a<|startoftext|>b.", "x" * 500, "." * 100, "é" * 80, "don't we'll 's 't"]
    want = [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(encoder, texts) == want


def test_memo_keeps_what_was_used_last():
    asked = []

    def learn(keys):
        asked.extend(keys)
        return [x * 10 for x in keys]

    memo = Memo(2, learn)
    assert memo.of([1, 2, 3]) == [10, 20, 30]
    assert memo.of([4, 1]) == [40, 10]
    assert asked == [1, 2, 3, 4]
    assert memo.of([2, 5]) == [20, 50]
    assert memo.of([7]) == [70]
    assert memo.of([3]) == [30]
    assert asked == [1, 2, 3, 4, 5, 7, 3]


@given(st.integers(0, 100_000))
def test_piece_lengths(total):
    lengths = piece_lengths(total, 2048)
    assert sum(lengths) == total
    assert all(x & (x - 1) == 0 and x <= 2048 for x in lengths)
    assert max(Counter(x for x in lengths if x < 2048).values(), default=0) <= 1


def test_pieces_round_trip(spark):
    tokenizer = Tokenizer.from_file(PATH)
    rows = odd_rows()
    got = pack(with_clashes(odd_docs(spark)), PATH, longest=64).collect()
    whole = Counter()
    pieces: dict[int, list] = {}
    for r in got:
        assert r.length == len(r.ids) == 1 << r.bucket
        assert r.length <= 64
        assert r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        pieces.setdefault(r.doc_id, []).append(r)
    assert len({r.sequence_id for r in got}) == len(got)
    for doc_id, text, *_ in rows:
        whole[doc_id, (*tokenizer.encode(text or "", add_special_tokens=False).ids, 1)] += 1
    by_id: dict = {}
    for doc_id, ids in whole.elements():
        by_id.setdefault(doc_id, []).append(ids)
    for doc_id, expected in by_id.items():
        # Rows that share an id: each start comes up once per row that is long enough.
        starts = Counter(r.start for r in pieces[doc_id])
        assert sum(r.length for r in pieces[doc_id]) == sum(map(len, expected))
        assert starts[0] == len(expected)
        if len(expected) == 1:
            joined = [x for r in sorted(pieces[doc_id], key=lambda r: r.start) for x in r.ids]
            assert tuple(joined) == expected[0]
            assert {r.doc_tokens for r in pieces[doc_id]} == {len(expected[0])}


def test_empty_table_and_wrong_length(spark):
    assert found(pack(no_docs(spark), PATH)) == []
    with pytest.raises(ValueError, match="power of two"):
        pack(no_docs(spark), PATH, longest=1000)


def test_buckets_are_sorted_longest_first_in_ids(spark):
    got = pack(odd_docs(spark), PATH, longest=64, with_ids=False).orderBy("sequence_id").collect()
    buckets = [r.bucket for r in got]
    assert buckets == sorted(buckets, reverse=True)
