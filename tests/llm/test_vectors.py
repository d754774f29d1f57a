import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import topk, vectors

DDL = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, copies STRING, node INT"
NAN, INF = float("nan"), float("inf")


def cloud(n=300, dims=16, seed=5):
    """Vectors in tight and loose clusters, with exact copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = []
    for k in range(n):
        spread = (0.02, 0.1, 0.2)[k % 3]
        v = centres[rng.integers(12)] + spread * rng.normal(size=dims)
        rows.append((k + 10, [float(np.float32(x)) for x in v], k % 2, "x", 1))
    rows += [(1000 + k, rows[k % 3][1], rows[k % 3][2], "x", 1) for k in range(40)]
    return rows


ODD = [
    (1, None, 0, "x", 1), (2, [0.0] * 16, 0, "x", 1), (3, [1.0] * 15 + [None], 0, "x", 1),
    (4, [NAN] + [1.0] * 15, 0, "x", 1), (5, [INF] * 16, 0, "x", 1), (6, [], 0, "x", 1),
    (7, [1.0, 2.0], 0, "x", 1), (8, [2.0, 4.0], 0, "x", 1), (9, [1.0] * 16, None, "x", 1),
]


def fit(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def brute_links(rows, threshold=0.93):
    ids = [r[0] for r in rows]
    least = {i: i for i in ids}
    count = dict.fromkeys(ids, 0)

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for x, a in enumerate(rows):
        for b in rows[x + 1 :]:
            if a[2] is None or a[2] != b[2] or not fit(a[1]) or not fit(b[1]) or len(a[1]) != len(b[1]):
                continue
            u, v = np.array(a[1]), np.array(b[1])
            if u.any() and v.any() and u @ v / np.sqrt((u @ u) * (v @ v)) >= threshold:
                count[a[0]] += 1
                count[b[0]] += 1
                lo, hi = sorted((root(a[0]), root(b[0])))
                least[hi] = lo
    return {i: (count[i], root(i), root(i) == i) for i in ids}


@pytest.mark.parametrize("tile", [17, 2048])
def test_near_duplicates(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    rows = cloud() + ODD
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), DDL)
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect()}
    assert out == brute_links(rows)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 64)) * rng.choice([1e-30, 1.0, 1e30], size=(200, 1))
    q, step, error = vectors.quantise(x)
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    back = q * step[:, None]
    slack = np.linalg.norm(back, axis=1)[:, None] * error[None, :] + error[:, None]
    assert (np.abs(unit @ unit.T - back @ back.T) <= slack + vectors.SLACK).all()


def test_near_duplicates_edges(spark):
    rows = [(1, [1.0, 0.0], 1, "x", 1)] * 2 + [(None, [1.0, 0.0], 1, "x", 1), (None, [0.0, 1.0], 1, "x", 1)]
    out = sorted(map(tuple, vectors.near_duplicates(spark.createDataFrame(rows, DDL)).collect()), key=repr)
    expected = [(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, True), (None, 2, 1, False)]
    assert out == sorted(expected, key=repr)
    assert vectors.near_duplicates(spark.createDataFrame([], DDL)).collect() == []


def brute_top(rows, k=5, every=50):
    whole = {r[0]: np.floor(256 * np.array(r[1], dtype=float)) for r in rows if fit(r[1])}
    out = []
    for q, u in whole.items():
        if q % every == 0:
            scores = [(-int(u @ v), i) for i, v in whole.items() if i != q and len(v) == len(u)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block,leaf", [((7, 50), 4), ((2048, 16_384), 48)])
def test_top_k(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block[1])
    monkeypatch.setattr(topk, "LEAF", leaf)
    rows = cloud() + ODD
    df = spark.createDataFrame(rows, DDL)
    out = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 10 == 0).collect()))
    assert out == brute_top(rows, every=10)


def test_top_k_edges(spark):
    rows = [(0, [1.0, 0.0], 1, "x", 1)] * 2 + [(k, [1.0, 0.0], 1, "x", 1) for k in (7, 3, 5)]
    rows += [(None, [9.0, 9.0], 1, "x", 1), (50, [1.0], 1, "x", 1)]
    out = [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, DDL), F.col("vec_id") % 50 == 0).collect()]
    assert sorted(out) == [(0, 1, 3, 65536), (0, 2, 5, 65536), (0, 3, 7, 65536)]
    assert topk.top_k(spark.createDataFrame([], DDL), F.col("vec_id") % 50 == 0).collect() == []


def test_covering_radii_and_pruning():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 8)) * 10
    x = np.floor(256 * (centres[rng.integers(20, size=3000)] + 0.05 * rng.normal(size=(3000, 8))))

    def check(node):
        assert np.linalg.norm(x[node.points] - node.centre, axis=1).max() <= node.radius
        if node.children:
            assert sorted(np.concatenate([c.points for c in node.children])) == sorted(node.points)
        for child in node.children:
            check(child)

    check(topk.cover_tree(x, 16))
    search = topk.Search(x[:100], np.arange(100), x, np.arange(3000), 5)
    search.run()
    assert search.pairs < 100 * 3000 / 2  # clusters are left out whole
    exact = (x[:100] @ x.T).astype(int)
    np.fill_diagonal(exact, -(2**60))
    assert (search.scores == -np.sort(-exact, axis=1)[:, :5]).all()
