import numpy as np
import pytest

from chirpline.llm.embeddings import Index, block_links, embedding_groups

SCHEMA = "vec_id long, embedding array<double>, label int"


def clustered(n=300, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    near = np.concatenate([base[i % 40] + rng.standard_normal(dim) * 0.12 for i in range(200)]).reshape(-1, dim)
    return np.concatenate([base, near, base[:10]]) * rng.uniform(0.1, 10, (n + 210, 1))


def brute(rows, least=0.93):
    sound = {}
    for i, (vec_id, x, label) in enumerate(rows):
        if vec_id is not None and label is not None and x and None not in x:
            v = np.array(x, dtype=np.float64)
            if np.isfinite(v).all() and v.any():
                v = v / np.abs(v).max()
                sound[i] = (label, v / np.linalg.norm(v))
    links, group = [0] * len(rows), list(range(len(rows)))
    for i, (a, v) in sound.items():
        for j, (b, w) in sound.items():
            if j < i and a == b and len(v) == len(w) and v @ w >= least:
                links[i] += 1
                links[j] += 1
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if group[k] == group[i]]
        least_id = min(ids) if vec_id is not None else None
        out.append((vec_id, links[i], least_id, vec_id == least_id))
    return sorted(out, key=repr)


def odd_rows():
    rows = [(i, x.tolist(), int(i % 3)) for i, x in enumerate(clustered())]
    x = rows[0][1]
    return [
        *rows,
        (1000, None, 0),
        (1001, [0.0] * 16, 0),
        (1002, [float("nan"), *x[1:]], 0),
        (1003, [float("inf"), *x[1:]], 0),
        (1004, [None, *x[1:]], 0),
        (1005, x, None),
        (1006, [], 0),
        (1007, [1.0, 2.0, 3.0], 0),
        (1008, [2.0, 4.0, 6.0], 0),
        (1009, [v * 1e200 for v in x], 0),
        (1010, [v * 1e-200 for v in x], 0),
        (None, x, 0),
        *[(1100 + i, x, 0) for i in range(50)],
    ]


def test_groups(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "'x' AS n", "'y' AS id", "1 AS cell")
    got = embedding_groups(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_no_sound_vector_and_no_row(spark):
    assert embedding_groups(spark.createDataFrame([], SCHEMA)).collect() == []
    got = embedding_groups(spark.createDataFrame([(3, None, 1), (4, [0.0], 1)], SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [(3, 0, 3, True), (4, 0, 4, True)]


def test_a_link_found_from_one_side_counts_for_both():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 12))
    x = np.concatenate([x, x + rng.standard_normal(x.shape) * 0.08])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for recall in (0.0, 0.9, 1.0):
        index = Index.fit(unit[:200], 10, (2 - 2 * 0.93) ** 0.5, recall)
        own = (unit @ index.centres.T - 0.5 * (index.centres**2).sum(axis=1)).argmax(axis=1)
        codes, errors = index.encode(unit, own)
        probes = index.probes(unit, own)
        assert probes[np.arange(len(x)), own].all()
        links = np.zeros(len(x), int)
        for cell in range(len(index.centres)):
            q, m = np.flatnonzero(probes[:, cell]), np.flatnonzero(own == cell)
            if len(m):
                pack = lambda i: {"id": i, "n": np.ones(len(i), int), "cell": own[i], "vector": unit[i], "unit": unit[i], "norm": np.ones(len(i))}
                ids, found, _, _ = block_links(index, cell, 0.93, pack(q), pack(m) | {"codes": codes[m], "errors": errors[m]})
                np.add.at(links, ids, found)
        near = unit @ unit.T >= 0.93
        seen = probes[:, own] & near
        np.fill_diagonal(seen, False)
        assert links.tolist() == (seen | seen.T).sum(axis=1).tolist()
    assert links.tolist() == (near.sum(axis=1) - 1).tolist()


def test_table_distances_leave_no_near_vector_out():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 10))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    index = Index.fit(unit[:100], 4, 0.5, 0.995)
    codes, errors = index.encode(unit, np.zeros(300, int))
    far = np.linalg.norm(unit[:, None] - unit[None], axis=2) > 0.5
    assert (index.near(unit, 0, codes, errors) | far).all()


@pytest.mark.parametrize(("dim", "inner", "groups"), [(384, 6, 1), (768, 6, 1), (768, 8, 1), (384, 6, 12), (384, 384, 1)])
def test_recall_on_vectors_of_few_directions(dim, inner, groups):
    rng = np.random.default_rng(7)
    n = 4000
    parts = [rng.standard_normal((n // groups, inner)) @ rng.standard_normal((inner, dim)) for _ in range(groups)]
    x = np.concatenate(parts)
    # Near copies, which differ as the vectors do.
    x = np.concatenate([x, x[:2000] + 0.3 * x[rng.permutation(len(x))[:2000]] * (groups == 1)])
    unit = rng.permutation(x / np.linalg.norm(x, axis=1, keepdims=True))
    index = Index.fit(unit, 38, (2 - 2 * 0.93) ** 0.5, 0.995)
    own = (unit @ index.centres.T - 0.5 * (index.centres**2).sum(axis=1)).argmax(axis=1)
    seen = index.probes(unit, own)[:, own]
    near = np.triu(unit @ unit.T >= 0.93, 1)
    assert near.sum() > 1000
    assert (near & (seen | seen.T)).sum() >= 0.97 * near.sum()


def planted(n, dim, seed, copies=2_000):
    """Vectors of any direction, some with a near one; labels of ten kinds."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step = rng.standard_normal((copies, dim))
    step -= (step * x[:copies]).sum(axis=1, keepdims=True) * x[:copies]
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    angle = np.arccos(rng.uniform(0.93, 0.99, copies))[:, None]
    label = rng.integers(0, 10, n)
    return np.concatenate([x, np.cos(angle) * x[:copies] + np.sin(angle) * step]), np.concatenate([label, label[:copies]])


@pytest.mark.parametrize(("n", "dim", "lists", "share"), [(48_000, 64, 111, 0.08), (18_000, 256, 70, 0.08)])
def test_few_lists_are_probed_where_vectors_point_anywhere(n, dim, lists, share):
    x, _ = planted(n, dim, 1)
    index = Index.fit(x[np.random.default_rng(2).permutation(len(x))[:16384]], lists, (2 - 2 * 0.93) ** 0.5, 0.995)
    own = (x @ index.centres.T - 0.5 * (index.centres**2).sum(axis=1)).argmax(axis=1)
    seen = index.probes(x, own)
    assert (seen * np.bincount(own, minlength=lists)).sum() < share * len(x) ** 2
    a, b = np.arange(2_000), n + np.arange(2_000)
    assert (seen[a, own[b]] | seen[b, own[a]]).mean() >= 0.98


def test_recall_of_the_whole_search(spark):
    """Against all pairs, on vectors that hold links of every strength."""
    x, label = planted(6_000, 64, 3, 1_500)
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    got = {r.vec_id: r.n_links for r in embedding_groups(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()}
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    want = near.sum(axis=1)
    assert want.sum() >= 3_000
    assert all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.98 * want.sum()
