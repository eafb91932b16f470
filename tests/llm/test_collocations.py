import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chirpline.llm import collocations as collocations_module
from chirpline.llm.collocations import Marks, Tokens, coded, collocations, found_texts, frequent_phrases, phrase_counts

from .cases import DOC_SCHEMA, found, no_docs, odd_docs, odd_rows, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return f, n


def brute(rows, least=30, listed=2000):
    f, n = brute_counts(rows)
    out = []
    for lang, counts in f.items():
        candidates = {x: a for x, a in counts.items() if len(x) > 1 and a >= least}
        covered = Counter()
        for x, a in candidates.items():
            for size in range(2, len(x)):
                for i in range(len(x) - size + 1):
                    covered[x[i : i + size]] = max(covered[x[i : i + size]], a)
        scored = []
        for x, a in candidates.items():
            if 100 * covered[x] >= 80 * a:
                continue
            cuts = [(counts[x[:k]], counts[x[k:]]) for k in range(1, len(x))]
            score, _, left, right = min((2_000_000 * a // (y + z), k, y, z) for k, (y, z) in enumerate(cuts))
            scored.append((-score, -a, " ".join(x).encode(), left, right))
        scored.sort()
        out += [
            (lang, i + 1, x.decode(), -a, left, right, n[lang], -score)
            for i, (score, a, x, left, right) in enumerate(scored[:listed])
        ]
    return sorted(out, key=repr)


def corpus(seed, n=150):
    """Texts whose phrases overlap, repeat, cross pieces and stay just below or above the threshold."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "new", "York", "é", "😀", "a_b", "x" * 70, *"bcdefgh"]
    weights = [30, 20, 5, 5, 3, 3, 3, 1, *[2] * 7]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        if rng.random() < 0.4:
            words += ["in", "New", "York", "city"]
        text = "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ".", ", ", "\n", "; "]) for x in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"]), "s", len(text)))
    return rows


@pytest.mark.parametrize(("shards", "bits", "held"), [(1, 24, 1 << 23), (3, 12, 500), (4, 6, 1 << 23)])
def test_against_brute_force(spark, shards, bits, held):
    rows = corpus(shards)
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA).repartition(3))
    assert found(collocations(docs, least=8, shards=shards, cells=1 << bits, held_bytes=held)) == brute(rows, least=8)


def test_counts_are_whole_however_late_a_phrase_starts(spark):
    """Phrases that reach the threshold with their very last occurrence, in any shard."""
    rows = [(i, f"w{i % 3} x{i % 3} y{i % 3} z{i % 3}.", "en", "s", 0) for i in range(24)]
    rows += [(100 + i, "rare pair here now", "en", "s", 0) for i in range(8)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).coalesce(1)
    got = {(r.phrase): r.n for r in frequent_phrases(docs, least=8, shards=4).filter("length > 0").collect()}
    counts = brute_counts(rows)[0]["en"]
    assert got == {" ".join(x): a for x, a in counts.items() if a >= 8}
    assert got["rare pair here now"] == 8


def test_ties_and_the_number_of_rows_listed(spark):
    rows = [(i, " . ".join(f"{x} {y}" for x in "abc" for y in "de"), "en", "s", 0) for i in range(5)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    assert found(collocations(docs, least=5, listed=4)) == brute(rows, least=5, listed=4)
    assert len(found(collocations(docs, least=5, listed=4))) == 4


def test_longer_phrases_cover_shorter_ones_at_eighty_percent(spark):
    rows = [(i, "p q r", "en", "s", 0) for i in range(8)] + [(20 + i, "p q. q r. q r", "en", "s", 0) for i in range(2)]
    got = {r.phrase for r in collocations(spark.createDataFrame(rows, DOC_SCHEMA), least=8).collect()}
    assert got == {x[2] for x in brute(rows, least=8)} == {"p q r", "q r"}


def test_one_very_long_text_and_one_group_of_copies(spark):
    rows = [(i, "same old story told again", "en", "s", 0) for i in range(300)]
    rows += [(1000, "la " * 300_000 + "y" * 200_000, "fr", "s", 0)]
    assert found(collocations(spark.createDataFrame(rows, DOC_SCHEMA).repartition(4))) == brute(rows)


def test_odd_and_no_rows(spark):
    assert found(collocations(odd_docs(spark), least=2)) == brute(odd_rows(), least=2)
    assert found(collocations(no_docs(spark))) == []


def test_marks_keep_the_first_stop():
    marks = Marks(128)
    marks.add(np.array([1]), np.array([1]), np.array([-(2**63) + 1]), 3)
    marks.add(np.array([1, 2]), np.array([1, 0]), np.array([3, 1]), 5)
    assert marks.stops[0].nonzero()[0].tolist() == [64, 65, 127] and marks.stops[0][[64, 65, 127]].tolist() == [3, 5, 3]
    high = np.uint64(1 << 32)
    h = np.array([64 + 65 * int(high), 64 + 66 * int(high), 64 + 127 * int(high)], dtype=np.uint64)
    assert marks.of(1, h).tolist() == [5, 0, 3]


def listed(counts):
    """``length, digests, start, n`` of each phrase."""
    return sorted(
        (length, *(int(x[i]) for x in hashes), int(start[i]), int(n[i])) for hashes, length, start, n in counts for i in range(len(n))
    )


def test_only_started_phrases_are_counted():
    texts = [b"a b c. a b"]
    tokens = Tokens("en", *coded(texts), 0)
    assert tokens.words == [b"\n", b"a", b"b", b"c"] and tokens.ids.tolist() == [1, 2, 3, 0, 1, 2]
    rows = listed(phrase_counts("en", tokens, None, 1, 3))
    assert sorted((x[0], x[4]) for x in rows) == [(0, 5), (1, 1), (1, 2), (1, 2)]
    marks = Marks(1 << 12)
    for low in tokens.own[1, 1:3].tolist():
        for cell in (low & 4095, (low >> 32) & 4095):
            marks.stops[0, cell] = 1
    assert [(x[0], x[3], x[4]) for x in listed(phrase_counts("en", tokens, marks, 4, 3))] == [(2, 1, 2)]
    assert listed(phrase_counts("en", tokens, marks, 5, 3)) == []


def test_digests_differ_by_language_words_and_seed():
    def digests(lang, text, seed):
        return {tuple(hashes[:, i].tolist()) for _, inside, hashes in Tokens(lang, *coded([text]), seed).phrases() for i in np.flatnonzero(inside)}

    groups = [digests("en", b"a b c d", 0), digests("de", b"a b c d", 0), digests("en", b"a b c d", 1), digests("en", b"d c ba", 0)]
    assert [len(x) for x in groups] == [10, 10, 10, 6]
    assert len(set.union(*groups)) == 10 + 10 + 10 + 6 - 2


def test_texts_come_from_the_block_that_is_asked():
    tokens = Tokens("en", *coded([b"a b c. a b\tc d"]), 0)
    every = {}
    for length, inside, hashes in tokens.phrases():
        for i in np.flatnonzero(inside).tolist():
            every[tuple(hashes[:, i].tolist())] = (length, tokens.text(length, i))
    wanted = {x: length for x, (length, _) in every.items()}
    assert sorted(found_texts("en", tokens, wanted, 0)) == sorted((x, text) for x, (_, text) in every.items())
    assert sorted(x for _, x in every.values()) == sorted(b"a,b,c,d,a b,b c,c d,a b c,b c d,a b c d".split(b","))
    assert found_texts("en", tokens, {(1, 2): 1}, 0) == []


def test_phrases_with_one_digest_are_counted_again(spark, monkeypatch):
    """With the digests of the first seed all alike, the second gives the counts."""
    plain = collocations_module._scan
    tried = []

    def scan(shard, marks, step, shards, seed):
        tried.append(seed)
        return plain(shard, marks, step, shards, seed)

    monkeypatch.setattr(collocations_module, "_scan", scan)
    texts = collocations_module._texts

    def doubled(dealt, counted, seed):
        found = texts(dealt, counted, seed)
        return found if seed else found.unionByName(found.selectExpr("high", "low", "lang", "concat(phrase, '!') AS phrase"))

    monkeypatch.setattr(collocations_module, "_texts", doubled)
    rows = corpus(9, 60)
    assert found(collocations(spark.createDataFrame(rows, DOC_SCHEMA), least=8)) == brute(rows, least=8)
    assert set(tried) == {0, 1}


def test_a_scan_hands_on_a_row_for_each_bucket(spark):
    """Not one for each phrase; what is packed there adds up to all counts."""
    rows = corpus(5, 40)
    docs = spark.createDataFrame([(x[2] or "und", x[1]) for x in rows], "lang string, text string").coalesce(1)
    dealt = collocations_module._dealt(docs, 1, 300).drop("shard")
    marks = Marks(1 << 6)
    marks.stops[:] = 1
    sent = spark.sparkContext.broadcast(collocations_module.Sent(marks, 4))
    packed = collocations_module._scan(dealt, sent, 1, 1, 0)
    assert packed.columns == ["bucket", "rows"] and packed.groupBy("bucket").count().count() == 16
    blocks = dealt.count()
    assert packed.count() <= blocks * (collocations_module.LONGEST + 1) * 16
    added = collocations_module._added_up(packed, 1, 8, 1)
    parts = {x.part: x.n for x in added.groupBy("part").agg({"bucket": "count"}).withColumnRenamed("count(bucket)", "n").collect()}
    assert set(parts) == {"over", "open", "new"} and max(parts.values()) <= 16
    got = collocations_module._unpacked(added.filter("part = 'over' OR part = 'open'")).filter("length > 0")
    counts, _ = brute_counts(rows)
    assert sorted((x.length, x.n) for x in got.collect() if x.length > 1 or x.n >= 8) == sorted(
        (len(x), n) for c in counts.values() for x, n in c.items() if len(x) > 1 or n >= 8
    )


def test_packed_rows_are_added_up_by_both_halves_of_a_digest():
    rng = np.random.default_rng(0)
    high, low = rng.integers(-2, 2, 500), rng.choice([-(2**63), -1, 0, 1, 2**63 - 1, 5 << 40, (5 << 40) + 1], 500)
    n = rng.integers(1, 9, 500)
    kind = collocations_module._kind(3, np.full(500, 2), 7)
    expected = Counter()
    for *digest, x in zip(high.tolist(), low.tolist(), n.tolist(), strict=True):
        expected[tuple(digest)] += x
    got = collocations_module._summed(np.stack([high, low, n, kind]))
    assert {(a, b): x for a, b, x, _ in got.T.tolist()} == expected and got.shape[1] == len(expected)
    assert set(got[3].tolist()) == {int(kind[0])}
    keys = rng.integers(0, 2**64, 5000, dtype=np.uint64) >> rng.integers(0, 60, 5000, dtype=np.uint64)
    assert (keys[collocations_module._order(keys)] == np.sort(keys)).all()


def test_texts_are_coded_by_first_appearance_with_one_mark_between_pieces():
    assert [(words, ids.tolist()) for words, ids in map(coded, ([b""], [b".\n"], [b" B a,, b\tC", b"", b"a"]))] == [
        ([], []),
        ([], [0]),
        ([b"b", b"a", b"c"], [1, 2, 0, 1, 3, 0, 2]),
    ]
