"""Exact nearest neighbours against brute force."""

import numpy as np

from churnscope.operators import ml_prep as mp
from churnscope.operators import neighbours as nb


def brute(ids, x, k):
    d = nb.squared_distances(x, x)
    out = []
    for i, a in enumerate(ids):
        best = sorted((d[i, j], b) for j, b in enumerate(ids) if b != a)[:k]
        out += [(a, n + 1, b, s) for n, (s, b) in enumerate(best)]
    return sorted(out)


def found(spark, ids, x, k, **kw):
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in zip(ids, x)], "a long, v array<double>")
    return sorted(tuple(r) for r in nb.nearest(rows, k, **kw).collect())


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(m, 0.3, (60, 5)) for m in (0, 4, 9)] + [rng.normal(0, 30, (20, 5))])
    x = np.concatenate([x, np.repeat(x[:1], 100, axis=0), x[5:8], np.round(x[:40])])     # a third of all rows on one point, ties
    ids = rng.permutation(1000)[:len(x)].tolist()
    assert found(spark, ids, x, 5) == brute(ids, x, 5)
    assert found(spark, ids, x, 5, pivots=7, block=16) == brute(ids, x, 5)


def test_few_rows(spark):
    x = np.array([[0.0], [0.0], [2.0]])
    assert found(spark, [7, 3, 5], x, 5) == brute([7, 3, 5], x, 5)
    assert found(spark, [7], x[:1], 5) == [] and found(spark, [], x[:0], 5) == []
    assert found(spark, list(range(9)), np.ones((9, 2)), 3) == brute(list(range(9)), np.ones((9, 2)), 3)


def test_synthetic_rows_use_true_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 6 == 0), *rng.normal(size=4).tolist()) for i in range(360)]
    feats = ["a", "b", "c", "d"]
    out = mp.smote_oversample(spark.createDataFrame(rows, "CustomerID long, is_churned int, a double, b double, c double, d double"), feats)
    minority = [r for r in rows if r[1] == 1]
    true = {}
    for a, _, b, _ in brute([r[0] for r in minority], np.array([r[2:] for r in minority]), 5):
        true.setdefault(a, set()).add(b)
    made = out.where("synthetic").collect()
    assert len(made) == 150 - 60 and all(r.neighbour in true[r.parent] for r in made)
