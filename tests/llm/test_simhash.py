import random

import numpy as np
import xxhash

from chirpline.llm.components import components
from chirpline.llm.simhash import fingerprint, near_links, shingle_hashes, simhash_dedup, simhash_groups, tile_links

from .cases import DOC_SCHEMA, found, no_docs, odd_docs, odd_rows, with_clashes


def plain_print(text, width=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute(rows, radius=4):
    prints = [plain_print(x[1]) for x in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = group[i], group[j]
                group = [b if x == a else x for x in group]
    least = {}
    for g, row in zip(group, rows):
        least.setdefault(g, []).append(row[0])
    return sorted(
        ((row[0], f"{p:016x}", min((x for x in least[g] if x is not None), default=None)) for row, p, g in zip(rows, prints, group)),
        key=repr,
    )


def test_fingerprints():
    for text in (None, "", " ", "A b", "a B c d", "a b c d e f g a b c d", "Éa é"):
        got = fingerprint(shingle_hashes((text or "").encode(), 4))
        assert got & (1 << 64) - 1 == plain_print(text)


def test_groups(spark):
    rows = odd_rows()
    assert found(simhash_groups(odd_docs(spark))) == brute(rows)


def test_tiles_find_all_links_of_random_and_clustered_prints(spark):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for x in list(prints)[:30]:
        for _ in range(6):
            prints.add(x ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(1, 5))}))
    chain = rng.getrandbits(64)
    for b in range(0, 60, 3):
        chain ^= 0b111 << b
        prints.add(chain)
    prints = sorted(prints)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    label = {x: x for x in signed}
    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= 4:
                a, b = label[signed[i]], label[signed[j]]
                label = {k: b if v == a else v for k, v in label.items()}
    want = {}
    for k, v in label.items():
        want.setdefault(v, set()).add(k)
    for tile in (8, 1 << 14):
        got = {}
        for r in components(near_links(df, 4, tile)).collect():
            got.setdefault(r.component, set()).add(r.node)
        assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_a_tile_gives_a_forest_not_all_pairs():
    a = np.array([1 << i for i in range(40)], np.int64)
    links = tile_links(a, a, 4, True)
    assert len(links[0]) == 39


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(-5, 200), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, -5: -5, 200: -5}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table(spark):
    assert found(simhash_groups(no_docs(spark))) == []


def test_dedup_keeps_one_of_each_group(spark):
    docs = with_clashes(odd_docs(spark))
    kept = simhash_dedup(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    want = sorted({x[0] for x in brute(odd_rows()) if x[0] is not None and x[0] == x[2]})
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == want


def test_dedup_decides_by_row_and_keeps_one_of_each_group(spark):
    rng = random.Random(9)
    long, alone, nameless, lost = (" ".join(str(rng.random()) for _ in range(300)) for _ in range(4))
    rows = [
        (1, long, "en", "s", 1),
        # Near copies of another id, and a text of its own under the same id.
        (2, long + " x", "en", "s", 1),
        (2, alone, "en", "s", 1),
        # Of near copies and repeated rows with the smallest id, one.
        (1, long + " y", "en", "s", 1),
        (1, long, "en", "s", 1),
        (None, long, "en", "s", 1),
        # Groups without any id.
        *[(None, nameless + end, "en", "s", 1) for end in ("", "", " x", " y")],
        *[(None, lost, lang, "s", 1) for lang in ("en", "de")],
        *[(None, text, "en", "s", 1) for text in (None, "")],
    ]
    groups = {}
    for row, (_, p, _) in zip(rows, (brute([x])[0] for x in rows)):
        groups.setdefault(next((k for k in groups if (int(k, 16) ^ int(p, 16)).bit_count() <= 4), p), []).append(row)
    assert sorted(map(len, groups.values())) == [1, 2, 2, 4, 5]
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA).repartition(4))
    kept = simhash_dedup(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    starts = sorted(((r.doc_id, (r.text or "")[:20]) for r in kept.collect()), key=repr)
    assert starts == sorted([(1, long[:20]), (2, alone[:20]), (None, nameless[:20]), (None, lost[:20]), (None, "")], key=repr)
    assert found(kept) == found(simhash_dedup(docs.repartition(3)))
    odd = simhash_dedup(with_clashes(odd_docs(spark))).collect()
    assert len(odd) == len({(r[2] if r[2] is not None else r[1]) for r in brute(odd_rows())})
