import itertools

import numpy as np
import pytest

from qmeasures.llm import lattice


def brute(rows, least=0.9):
    def ok(v):
        return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(n), 2):
        a, b = rows[i][1], rows[j][1]
        if ok(a) and ok(b) and len(a) == len(b):
            a, b = np.array(a, float) / max(map(abs, a)), np.array(b, float) / max(map(abs, b))
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return [(k, links[i], low.get(find(i)) if ok(v) else k, k is not None and k == (low.get(find(i)) if ok(v) else k))
            for i, (k, v) in enumerate(rows)]


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(40, 64))
    out = []
    for c in centers:
        for spread in [0.0] + [0.02, 0.1, 0.25][:rng.integers(0, 4)]:
            out.append((c + spread * rng.normal(size=64)).tolist())
    for _ in range(70):
        out.append((centers[0] + 0.15 * rng.normal(size=64)).tolist())
    rows = list(enumerate(out))
    rows += [(500, out[0]), (501, out[0]), (3, out[3]), (502, None), (503, []), (504, [0.0] * 64), (505, [float("nan")] * 64),
             (506, [float("inf")] + [1.0] * 63), (507, [None] + [1.0] * 63), (508, [1.0, 2.0]), (509, [1.0, 2.1]), (510, [-1.0, -2.0]),
             (511, [1e200] * 64), (512, [1e-200] * 64), (None, out[5]), (None, None), (513, [-0.0, 1.0]), (514, [0.0, 2.0])]
    return rows


@pytest.mark.parametrize("block", [4096, 7])
def test_against_brute_force(spark, block):
    rows = vectors()
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, n_links int")
    got = lattice.near_duplicates(df, block=block).collect()
    want = brute(rows)
    total = sum(r[1] for r in want)
    assert sum(r.n_links for r in got) >= 0.97 * total and total > 4000
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))  # with these seeds nothing is missed


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(1500, 64))
    b -= (b * a).sum(axis=1)[:, None] * a
    b = 0.901 * a + np.sqrt(1 - 0.901 ** 2) * b / np.linalg.norm(b, axis=1)[:, None]
    one, two = (lattice.cells(x, 10, 2, 3.5, 8) for x in (a, b))
    meets = ((one[:, :, :1] == two) | (two[:, :, :1] == one)).any(axis=(1, 2))
    assert meets.mean() >= 0.9


def test_nearest_points_are_lattice_points():
    rng = np.random.default_rng(2)
    y = rng.uniform(-3, 3, size=(400, 8))
    found = lattice.nearest_points(y)
    doubled = np.rint(2 * found).astype(int)
    assert np.allclose(doubled / 2, found)
    assert ((doubled % 2 == doubled[..., :1] % 2).all(axis=-1) & (found.sum(axis=-1) % 2 == 0)).all()
    roots = [np.array(p) for p in itertools.product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in p) % 2 == 0]
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            roots.append(v)
    gap = ((found[:, 0] - y) ** 2).sum(axis=-1)
    around = ((found[:, 0][:, None] + np.array(roots) - y[:, None]) ** 2).sum(axis=-1).min(axis=1)
    assert len(roots) == 240 and (gap <= around + 1e-9).all()


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert lattice.near_duplicates(df).collect() == []
