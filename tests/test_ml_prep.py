"""Split, scaler, weights and SMOTE."""

import numpy as np
from pyspark.sql import functions as F

from churnscope.operators import ml_prep as mp


def _frame(spark, n=400, pos_share=0.2, seed=3):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < pos_share).astype(int)
    x1 = rng.normal(size=n) + y * 2
    x2 = rng.normal(size=n) - y
    rows = [(int(i), int(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(y, x1, x2))]
    return spark.createDataFrame(rows, "CustomerID long, is_churned int, x1 double, x2 double")


def test_split_counts_and_rerun(spark):
    df = _frame(spark)
    a = mp.stratified_split(df)
    counts = {(r.is_churned, r.split): r["count"] for r in a.groupBy("is_churned", "split").count().collect()}
    for c in (0, 1):
        n = sum(v for (k, s), v in counts.items() if k == c)
        held = int(np.ceil(0.3 * n))
        assert counts[(c, "train")] == n - held
        assert counts[(c, "test")] == int(np.ceil(0.5 * held))
    b = mp.stratified_split(df)
    assert sorted(a.select("CustomerID", "split").collect()) == sorted(b.select("CustomerID", "split").collect())


def test_scaler_population_std(spark):
    df = _frame(spark)
    st = {r.feature: r for r in mp.scaler_stats(df, ["x1", "x2"]).collect()}
    x1 = np.array([r.x1 for r in df.collect()])
    assert abs(st["x1"].std - x1.std()) < 1e-9 and abs(st["x1"].mean - x1.mean()) < 1e-9


def test_class_weights(spark):
    df = _frame(spark)
    w = {r.label: r for r in mp.class_weights(df).collect()}
    n0, n1 = w[0].n_class, w[1].n_class
    assert abs(w[1].balanced_weight - (n0 + n1) / (2 * n1)) < 1e-12
    assert abs(w[0].pos_weight - n0 / n1) < 1e-12


def test_smote_reaches_ratio(spark):
    df = _frame(spark, n=300, pos_share=0.15)
    n1 = df.filter(F.col("is_churned") == 1).count()
    n0 = df.count() - n1
    out = mp.smote_oversample(df, ["x1", "x2"], ratio=0.5, k=5)
    syn = out.filter(F.col("synthetic"))
    assert syn.count() == int(0.5 * n0) - n1
    assert syn.filter(F.col("is_churned") != 1).count() == 0
    # synthetic points lie between minority points: inside the minority bounding box
    mins = df.filter(F.col("is_churned") == 1).agg(F.min("x1"), F.max("x1")).first()
    box = syn.agg(F.min("x1"), F.max("x1")).first()
    assert box[0] >= mins[0] - 1e-9 and box[1] <= mins[1] + 1e-9
