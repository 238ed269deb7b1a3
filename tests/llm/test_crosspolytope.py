from __future__ import annotations

import numpy as np
import pytest

from tillscope.llm import crosspolytope

SCHEMA = "vec_id long, embedding array<float>, label int, copies long"


def brute(rows, least=0.93):
    usable = [
        (i, np.asarray(v, dtype=np.float64), y) for i, v, y, _ in rows
        if y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, label = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for k, (i, a, y) in enumerate(usable):
        for j, b, z in usable[k + 1 :]:
            if y == z and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                links[i] += 1
                links[j] += 1
                p, q = root(i), root(j)
                label[max(p, q)] = min(p, q)
    return {i: (links[i], root(i)) for i in links}


def sample(seed=3, dim=24):
    rng = np.random.default_rng(seed)
    rows = []

    def add(v, y):
        rows.append((len(rows) * 2 + 1, [float(x) for x in np.asarray(v, dtype=np.float32)], y, 0))

    for _ in range(60):
        base = rng.standard_normal(dim)
        for _ in range(int(rng.integers(1, 6))):
            add(base + rng.standard_normal(dim) * 0.08, int(rng.integers(0, 2)))
    hot = rng.standard_normal(dim)
    for _ in range(60):
        add(hot + rng.standard_normal(dim) * 0.05, 1)
    for _ in range(15):
        add(hot, 1)
    add(hot * 3, 1)
    add(hot, None)
    more = [(901, None, 1, 0), (902, [0.0] * dim, 1, 0), (903, [float("nan")] + [1.0] * (dim - 1), 1, 0),
            (904, [None] + [1.0] * (dim - 1), 1, 0), (905, [], 1, 0), (906, [float("inf")] * dim, 1, 0), (907, [1.0, 2.0], 1, 0)]
    return rows + more


@pytest.mark.parametrize("block", [1024, 7])
def test_against_brute_force(spark, block):
    rows = sample()
    got = crosspolytope.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), block=block).collect()
    expected = brute(rows)
    assert sorted(r.vec_id for r in got) == sorted(expected)
    found, whole = sum(r.n_links for r in got), sum(n for n, _ in expected.values())
    assert 0.95 * whole <= found <= whole
    assert all(r.n_links <= expected[r.vec_id][0] for r in got)
    right = sum(r.component_id == expected[r.vec_id][1] for r in got)
    assert right >= 0.97 * len(got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_repeated_and_null_ids(spark):
    rows = [(5, [1.0, 0.0], 1, 0), (5, [1.0, 0.0], 1, 0), (None, [1.0, 0.01], 1, 0), (3, [0.0, 1.0], 1, 0), (None, [0.7, 0.7], 2, 0)]
    got = sorted(
        ((r.vec_id, r.n_links, r.component_id, r.kept) for r in crosspolytope.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr
    )
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False), (3, 0, 3, True), (None, 0, None, True)], key=repr)
    assert crosspolytope.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_large_and_small_components(spark):
    rows = [(1, [1e200, 1e199], 1), (2, [1e-200, 1.0001e-201], 1), (3, [-1e300, 0.0], 1), (4, [5e-324, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in crosspolytope.near_duplicates(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (0, 3), 4: (2, 1)}


def test_rotations_grow_with_the_label(spark):
    df = spark.createDataFrame([(5, 64), (600, 64), (50_000, 64), (200_000, 64), (5, 2), (600, 10), (50_000, 384)], "n long, w int")
    got = df.select("n", "w", crosspolytope.label_rotations("n", "w", 4).alias("r")).collect()
    assert {(r.n, r.w): r.r for r in got} == {
        (5, 64): 2, (600, 64): 3, (50_000, 64): 3, (200_000, 64): 4, (5, 2): 2, (600, 10): 3, (50_000, 384): 3,
    }


@pytest.mark.parametrize("rotations", [2, 3, 4])
def test_recall_at_the_bound(rotations):
    """Pairs of exactly the least cosine, 64 dimensions: at least 0.95 share a bucket."""
    rng = np.random.default_rng(rotations)
    a = crosspolytope._unit(rng.standard_normal((1500, 64)))
    b = rng.standard_normal(a.shape)
    b = crosspolytope._unit(b - (b * a).sum(axis=1, keepdims=True) * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    both = [crosspolytope.bucket_codes(x, crosspolytope.TABLES[rotations], rotations, crosspolytope.PROBES, 29) for x in (a, b)]
    met = (both[0][:, :, :, None] == both[1][:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() >= 0.95


def test_transform_is_an_isometry():
    rows = np.random.default_rng(0).standard_normal((5, 16))
    turned = crosspolytope.hadamard(rows)
    assert np.allclose(turned @ turned.T, rows @ rows.T)
    dense = np.array([[1.0]])
    while len(dense) < 16:
        dense = np.block([[dense, dense], [dense, -dense]])
    assert np.allclose(turned, rows @ dense / 4)
