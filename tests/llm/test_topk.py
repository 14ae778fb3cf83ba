import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from qmeasures.llm import topk


def brute(rows, k):
    use = [(i, key, [math.floor(64 * x) for x in v]) for i, (key, v) in enumerate(rows)
           if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, key, v in use:
        if key is None or key % 20:
            continue
        scored = [(-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), other if other is not None else 2 ** 63, j)
                  for j, other, w in use if j != i and len(w) == len(v)]
        out += [(key, r, None if o == 2 ** 63 else o, -s) for r, (s, o, _) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(seed, n=300, dim=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(scale=0.2, size=(12, dim))
    out = [(i, (base[rng.integers(12)] + rng.normal(scale=rng.choice([0.01, 0.3]), size=dim)).tolist()) for i in range(n)]
    out += [(i, [0.5] * dim) for i in range(400, 460)]  # ties
    out += [(40, [0.25] * dim), (None, [0.5] * dim), (600, None), (620, []), (640, [math.nan] * dim), (660, [None] * dim),
            (680, [math.inf] * dim), (700, [1.0, 2.0, -3.0]), (701, [0.5, 0.5, 0.5]), (720, [0.0] * dim)]
    return out


@pytest.mark.parametrize("blocks", [(2048, 16384), (3, 50)])
def test_against_brute_force(spark, blocks):
    data = rows(1)
    df = spark.createDataFrame([(k, v, 0) for k, v in data], "vec_id long, embedding array<double>, row int")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=20, query_block=blocks[0], row_block=blocks[1])
    assert sorted(map(tuple, got.collect()), key=str) == brute(data, 20)


def test_huge_components(spark):
    data = [(0, [1e15, -3.0, 2.0]), (1, [1e15, 5.0, 1.0]), (2, [-1e15, 5.0, 1.0]), (3, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0).collect())) == brute(data, 20)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for dim in (1, 3, 7, 64):
        q, c = rng.integers(-30, 30, (20, dim)).astype(float), rng.integers(-30, 30, (50, dim)).astype(float)
        exact = q @ c.T
        for edges in topk.segmentations(dim):
            bound = topk.statistics(q, edges) @ topk.statistics(c, edges).T
            assert (bound >= exact - 1e-6).all()


def _survivors(x, n_queries):
    seen = []
    q_row, c_row = np.arange(n_queries), np.arange(len(x))
    q, c, score = topk.search(x[:n_queries], q_row, x, c_row, c_row, 20, seen=seen)
    exact = x[:n_queries] @ x.T
    np.fill_diagonal(exact, -np.inf)
    want = -np.sort(-exact, axis=1)[:, :20]
    assert (score.reshape(n_queries, 20) == want).all()
    return np.array(seen).sum(axis=0) / (n_queries * len(x))


def test_levels_drop_candidates():
    rng = np.random.default_rng(5)
    smooth = np.floor(64 * np.repeat(rng.normal(size=(1500, 4)), 16, axis=1) + rng.normal(size=(1500, 64)))
    left = _survivors(smooth, 40)
    assert (np.diff(left) <= 0).all() and left[-1] < 0.1 and left[2] < 0.2  # coarse levels suffice
    noise = rng.normal(size=(1500, 64))
    left = _survivors(np.floor(64 * noise / np.linalg.norm(noise, axis=1, keepdims=True)), 40)
    assert left[3] > 0.9 and left[-1] < 0.4  # isotropic vectors: only the fine levels help


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).collect() == []
