import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import negatives
from tests.llm.test_vectors import DDL, ODD, cloud, fit

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=5, positives=5, k=3, low=50, high=95):
    whole = sorted({
        (i, lab, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v))
        for i, v, lab in rows if i is not None and lab is not None and fit(v)
    })
    anchors = {}
    for i, lab, v in whole:
        if i % every == 0:
            anchors.setdefault((i, len(v)), (i, lab, v))
    out = []
    for i, lab, v in anchors.values():
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in whole if j != i and len(w) == len(v)]
        best = sorted(x for x in scored if x[2] == lab)[:positives]
        for p, j, _ in best:
            inside = sorted(x for x in scored if x[2] != lab and -low * p <= -100 * x[0] <= -high * p)
            out += [(i, j, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(inside[:k])]
    return sorted(out)


def got(df, **options):
    out = negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, **options)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("block", [23, 5000])
def test_like_brute_force(spark, monkeypatch, block):
    for name in ("ANCHOR_BLOCK", "CANDIDATE_BLOCK", "ROWS", "COLUMNS"):
        monkeypatch.setattr(negatives, name, block)
    rnd = random.Random(2)
    rows = [(i, v, rnd.randrange(3), x, n) for i, v, _, x, n in cloud(250)] + ODD
    rows += [(2000, rows[5][1], rows[5][2], "y", 2), (None, rows[5][1], 1, "y", 2), (rows[7][0], *rows[7][1:3], "z", 9)]
    df = spark.createDataFrame(rows, DDL)
    expected = brute([r[:3] for r in rows])
    assert len(expected) > 300
    assert got(df) == expected
    assert got(df, positives=2, negatives=7, low=10, high=99) == brute([r[:3] for r in rows], 5, 2, 7, 10, 99)
    assert got(df.limit(0)) == []


def test_conflicting_rows_of_one_id(spark):
    rows = [(5, [1.0, 2.0], 0, "", 1), (5, [2.0, 1.0], 0, "", 1), (6, [1.0, 1.0], 0, "", 1), (6, [3.0, 1.0], 1, "", 1),
            (7, [1.0, 0.5], 1, "", 1), (7, [1.0, 0.5], 1, "", 1), (10, [-1.0, 0.0], 1, "", 1)]
    df = spark.createDataFrame(rows, DDL)
    assert got(df) == brute([r[:3] for r in rows])


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(60, 37)) * rng.uniform(0, 3, size=(60, 1)) + rng.normal(size=(60, 1)) * 100)
    means, deviations = negatives.summarise(x)
    score, start, widths = x @ x.T, 0, []
    for edges in negatives.levels(37):
        n = np.diff(edges)
        part = slice(start, start := start + len(n))
        middle = (means[:, part] * n) @ means[:, part].T
        spread = (deviations[:, part] * n) @ deviations[:, part].T
        assert (np.abs(score - middle) <= spread + 1e-6).all()
        widths.append(spread.mean())
    assert len(widths) > 2 and widths == sorted(widths, reverse=True)
    assert negatives.levels(1)[0].tolist() == [0, 1]


def search(x, label, every=10):
    n = len(x)
    side = negatives.Side(np.arange(n), label, x, *negatives.summarise(x))
    anchors = side.rows(np.arange(0, n, every))
    m = len(anchors.ids)
    s = negatives.Search(anchors, np.full((m, 1), negatives.EMPTY), np.full((m, 1), negatives.LARGEST), 5, True)
    s.run(side)
    return s


def test_summaries_settle_pairs_of_smooth_vectors():
    """Vectors that vary little inside a segment are told apart without exact scores."""
    rng = np.random.default_rng(3)
    steps = np.repeat(rng.normal(size=(12_000, 16)), 4, axis=1)
    x = np.floor(256 * (steps + 0.01 * rng.normal(size=(12_000, 64))))
    label = rng.integers(0, 2, 12_000)
    s = search(x, label)
    assert s.exact < s.pairs / 5
    scores = x[::10] @ x.T
    for row in range(0, 1200, 100):
        scored = np.where((label == label[row * 10]) & (np.arange(12_000) != row * 10), scores[row], -np.inf)
        best = np.lexsort((np.arange(12_000), -scored))[:5]
        assert s.best[row, 0].tolist() == best.tolist()
