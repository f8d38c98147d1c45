"""Evaluation and campaign operators against direct computations."""

import numpy as np
import pytest

from churnscope.operators import campaign as cp
from churnscope.operators import metrics as mt


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, size=800)
    s = np.round(np.clip(y * 0.3 + rng.random(800) * 0.7, 0, 1), 2)   # many ties
    aov = np.round(rng.random(800) * 100 + 1, 2)
    rows = [(int(i), int(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(y, s, aov))]
    df = spark.createDataFrame(rows, "CustomerID long, is_churned int, churn_probability double, "
                                     "avg_order_value double")
    return df, y, s, aov


def test_auc_mann_whitney(scored):
    df, y, s, _ = scored
    pos, neg = s[y == 1], s[y == 0]
    u = sum(((p > neg).sum() + 0.5 * (p == neg).sum()) for p in pos)
    assert mt.auc(df).first().auc == pytest.approx(u / (len(pos) * len(neg)), abs=1e-12)


def test_best_f1_threshold(scored):
    df, y, s, _ = scored
    best = None
    for t in sorted(set(s)):
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        p, r = tp / pred.sum(), tp / (y == 1).sum()
        f1 = 2 * (p * r) / (p + r + 1e-10)
        if best is None or f1 > best[1]:
            best = (t, f1)
    got = mt.best_f1_threshold(df).first()
    assert got.threshold == pytest.approx(best[0]) and got.f1 == pytest.approx(best[1])


def test_roi_does_not_depend_on_threshold(scored):
    df = scored[0]
    rows = cp.campaign_roi(df, [0.5, 0.6, 0.7]).collect()
    rois = {round(r.roi, 6) for r in rows if r.targets > 0}
    assert len(rois) == 1


def test_sweep_grid_is_the_original_float_grid():
    g = cp.sweep_thresholds()
    assert len(g) == 10 and g[0] == 0.4 and g[5] == 0.6499999999999999
