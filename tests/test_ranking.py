"""Distributed rank, running totals and exact quantiles against local
references."""

import numpy as np
from pyspark.sql import functions as F

from churnscope.operators.ranking import exact_quantiles, global_rank, running_total


def test_global_rank_equals_row_number_with_heavy_ties(spark):
    rng = np.random.default_rng(0)
    vals = rng.integers(0, 4, size=3000)          # a third of rows share each value
    vals[:1000] = 1                              # one hot value
    rows = [(int(i), int(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id long, v long")
    got = {r.id: r.rk for r in global_rank(df, [F.col("v"), F.col("id")], "rk",
                                           num_partitions=7).collect()}
    order = sorted(rows, key=lambda t: (t[1], t[0]))
    expected = {t[0]: i + 1 for i, t in enumerate(order)}
    assert got == expected


def test_global_rank_total(spark):
    df = spark.range(0, 1234).withColumn("v", F.col("id") % 10)
    out = global_rank(df, [F.col("v"), F.col("id")], "rk", total_col="n").agg(
        F.max("n"), F.min("rk"), F.max("rk"), F.countDistinct("rk")).first()
    assert tuple(out) == (1234, 1, 1234, 1234)


def test_running_total(spark):
    rows = [(i, i % 3 + 1) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, w long")
    got = {r.k: r.c for r in running_total(df, ["k"], "w", "c", num_partitions=5).collect()}
    acc = 0
    for k, w in rows:
        acc += w
        assert got[k] == acc


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.exponential(100, size=2001), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    q = exact_quantiles(df, "x", [0.25, 0.5, 0.75, 0.8]).first()
    for i, p in enumerate([0.25, 0.5, 0.75, 0.8]):
        assert abs(q[f"q_{i}"] - np.quantile(x, p)) < 1e-9


def test_multi_rank_matches_separate_ranks(spark):
    from churnscope.operators.ranking import multi_rank
    rng = np.random.default_rng(5)
    rows = [(int(i), int(a), int(b)) for i, (a, b) in
            enumerate(zip(rng.integers(0, 5, 700), rng.integers(0, 1000, 700)))]
    df = spark.createDataFrame(rows, "id long, a long, b long")
    out = {r.id: (r.rk_a, r.rk_b, r.n) for r in
           multi_rank(df, "id", {"a": "a", "b": "b"}, prefix="rk_", total_col="n",
                      num_partitions=6).collect()}
    ra = {t[0]: i + 1 for i, t in enumerate(sorted(rows, key=lambda t: (t[1], t[0])))}
    rb = {t[0]: i + 1 for i, t in enumerate(sorted(rows, key=lambda t: (t[2], t[0])))}
    assert out == {i: (ra[i], rb[i], 700) for i in ra}


def test_a_run_removes_its_own_tables_only(spark):
    import os
    from churnscope.operators.ranking import intermediates, materialize
    outside = materialize(spark.range(5), "x")
    with intermediates(spark, remove=True) as folder:
        inside = materialize(spark.range(3), "y")
        assert inside.count() == 3 and os.path.isdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
    assert outside.count() == 5
