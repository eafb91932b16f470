import re
from collections import Counter, defaultdict

import pytest

from chirpline.llm.divergence import divergence

from .cases import DOC_SCHEMA, found, no_docs, odd_docs, odd_rows, with_clashes

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCALE = 10**9


def brute(rows, least=3, listed=200):
    groups, n_docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(terms)
        n_docs[lang or ""].update(set(terms))
    kept = {lang: [x for x, n in c.items() if n >= least] for lang, c in n_docs.items()}

    def shares(n, terms):
        total = sum(n[x] for x in terms) + len(terms)
        return {x: 1 + SCALE * (n[x] + 1) // total for x in terms}

    whole = defaultdict(Counter)
    for (lang, _), n in groups.items():
        whole[lang].update(n)
    p = {g: shares(n, kept[g[0]]) for g, n in groups.items()}
    q = {lang: shares(whole[lang], kept[lang]) for lang in kept}
    out = []
    for lang, source in groups:
        own, n = p[lang, source], groups[lang, source]
        pairs = [(sum((own[x] - y) ** 2 // y for x, y in p[o].items()), o[1]) for o in groups if o[0] == lang and o[1] != source]
        terms = [((own[x] - q[lang][x]) ** 2 // q[lang][x], x) for x in own if n[x] and own[x] > q[lang][x]]
        for part, items, most in (("pair", pairs, None), ("term", terms, listed)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(items[:most])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_terms_that_share_a_digest_are_told_apart(spark, bits):
    assert found(divergence(with_clashes(odd_docs(spark)), digest_bits=bits)) == brute(odd_rows())


def test_ties_at_the_last_rank_go_by_the_bytes_of_the_term(spark):
    terms = " ".join(f"t{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)) + " ﬀ 😀 z"
    rows = [(i, terms, "en", "a", 0) for i in range(3)] + [(9, "zz zz", "en", "b", 0), (10, "", "en", "c", 0)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    assert found(divergence(docs, listed=7)) == brute(rows, listed=7)
    assert found(divergence(docs)) == brute(rows)


def test_a_language_that_keeps_no_term(spark):
    rows = [(1, "one", "en", "a", 0), (2, "two", "en", "b", 0), (3, None, None, None, 0), (4, "1 2 3", "", "x", 0)]
    got = found(divergence(spark.createDataFrame(rows, DOC_SCHEMA)))
    assert got == brute(rows)
    assert {x[4] for x in got} == {0} and len(got) == 4


def test_one_source_with_most_rows_and_one_very_long_text(spark):
    rows = [(i, "the of and " * (i % 5) + f"word{chr(97 + i % 26)}", "en", "hot" if i % 3 else f"s{i % 7}", 0) for i in range(400)]
    rows += [(1000, "long tail " * 200_000 + "x" * 300_000, "en", "s1", 0)]
    assert found(divergence(spark.createDataFrame(rows, DOC_SCHEMA).repartition(4))) == brute(rows)


def test_counts_beyond_long_products(spark):
    """Shares are exact where 10^9 times a count passes 64 bits."""
    from pyspark.sql import functions as F

    from chirpline.llm.divergence import share

    n = 9 * 10**15 + 7
    row = spark.range(1).select(share(F.lit(n), F.lit(n * 3), F.lit(11)).alias("p")).first()
    assert row.p == 1 + SCALE * (n + 1) // (3 * n + 11)


def test_no_rows(spark):
    assert found(divergence(no_docs(spark))) == []
