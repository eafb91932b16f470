import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from chirpline.llm.mixing import WEIGHTS, mix, mixed_documents, targets

from .cases import DOC_SCHEMA, found, no_docs, odd_docs, odd_rows, with_clashes


def count(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def plain_targets(sizes):
    """Raises all targets together and stops each at three times its source's size."""
    names = sorted((x for x in sizes if x is not None), key=lambda x: x.encode()) + [x for x in sizes if x is None]
    weight = {x: WEIGHTS[i % 3] for i, x in enumerate(names)}
    out, left, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        share = {x: left * weight[x] / sum(weight[y] for y in open_) for x in open_}
        over = {x for x in open_ if share[x] > 3 * sizes[x]}
        if not over:
            return {**out, **share}
        for x in over:
            out[x] = 3.0 * sizes[x]
            left -= out[x]
        open_ -= over
    return out


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, None: 500},
        {"a": 0, "b": 0},
        {"é": 7, "z": 3, "Z": 900, "a": 2, "b": 1, None: 0},
        {"only": 12},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def brute(rows):
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + count(text)
    goal = plain_targets(sizes)
    out = []
    for source, held in sizes.items():
        budget = math.floor(goal[source] + 1e-9)
        epochs, rest = divmod(budget, held) if held else (0, 0)
        mine = []
        for doc_id, text, _, s, _ in rows:
            if s == source:
                shown = re.sub("[\x20\x09-\x0d]", "", text or "")
                others = re.sub(r"[^\W\d_]", "", shown)
                weight = 1.05 - (len(others) / len(shown) if shown else 1.0)
                seed = "mix-1" if doc_id is None else f"mix-1:{doc_id}"
                u = (int(hashlib.md5(seed.encode()).hexdigest()[:12], 16) + 0.5) / 2**48
                mine.append((-math.log(u) / weight, doc_id if doc_id is not None else -1, count(text), doc_id))
        for _, _, size, doc_id in sorted(mine):
            once = max(0, min(size, rest))
            rest -= once
            out.append((doc_id, size, held, round(goal[source], 6), epochs * size + once))
    return sorted(out, key=repr)


def test_mix(spark):
    for docs in (odd_docs(spark), with_clashes(odd_docs(spark))):
        got = mix(docs).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")
        assert found(got) == brute(odd_rows())


def test_reruns_agree_however_rows_lie(spark):
    one = mix(odd_docs(spark, partitions=1)).select("doc_id", "taken")
    many = mix(odd_docs(spark, partitions=7)).select("doc_id", "taken")
    assert found(one) == found(many)


def test_documents_come_as_often_as_they_are_taken(spark):
    docs = with_clashes(odd_docs(spark))
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert {(r.size, r._key) for r in mixed.collect()} == {("x", "x")}
    words = {}
    for r in mixed.collect():
        words[r.source] = words.get(r.source, 0) + count(r.text)
        assert r.n_chars == len(r.text)
    want = {}
    for r in mix(docs).collect():
        want[r.source] = want.get(r.source, 0) + r.taken
    assert words == {k: v for k, v in want.items() if v}


def test_a_part_of_a_text_keeps_its_white_space(spark):
    docs = spark.createDataFrame([(1, "  a\tb  c ", "en", "x", 9), (2, "d " * 40, "en", "y", 80)], DOC_SCHEMA)
    for r in mixed_documents(docs).collect():
        whole = "  a\tb  c " if r.doc_id == 1 else "d " * 40
        assert whole.startswith(r.text)


def test_empty_table_and_texts_without_words(spark):
    assert found(mix(no_docs(spark))) == []
    blank = spark.createDataFrame([(1, None, "en", None, 0), (2, " ", "en", "x", 1)], DOC_SCHEMA)
    assert [r.taken for r in mix(blank).collect()] == [0, 0]
    assert mixed_documents(blank).collect() == []
