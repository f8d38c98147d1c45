"""Rows at positions by sampled splitters against sorting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnscope.functions.rules import quintile
from churnscope.operators import rfm as rf
from churnscope.operators import selection as sel
from churnscope.operators.ranking import multi_rank
from churnscope.plans import steps as st
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("sample", [3, 50, 5000])
def test_rows_equal_the_sorted_ones(spark, sample):
    rng = random.Random(sample)
    a = [rng.choice([5, 5, 5, rng.randrange(1000)]) for _ in range(3000)]
    rows = [(i, v, rng.randrange(-10 ** 12, 10 ** 12) if i % 7 else None) for i, v in enumerate(a)]
    df = spark.createDataFrame(rows, "id long, a long, b long").repartition(5)
    got = sel.rows_at(df, "id", ["a", "b"], lambda n: [1, 2, *sel.quintile_cuts(n), n], sample)
    for m, at in (("a", 1), ("b", 2)):
        order = sorted((r[at], r[0]) for r in rows if r[at] is not None)
        n, found = got[m]
        assert n == len(order) and found == {p: order[p - 1] for p in {1, 2, *sel.quintile_cuts(n), n}}


def test_rows_that_repeat_wholly_are_found_by_count(spark):
    rows = [(1, 7)] * 2000 + [(2, 7)] * 1500 + [(3, v) for v in range(20)]
    df = spark.createDataFrame(rows, "id long, a long")
    order = sorted((v, k) for k, v in rows)
    n, found = sel.rows_at(df, "id", ["a"], lambda n: [1, 8, 2007, 2008, 2009, 3508, n], 10)["a"]
    assert found == {p: order[p - 1] for p in (1, 8, 2007, 2008, 2009, 3508, n)}


def test_no_rows_one_row_no_values(spark):
    df = spark.createDataFrame([(4, 9, None)], "id long, a long, b long")
    got = sel.rows_at(df, "id", ["a", "b"], sel.quintile_cuts)
    assert got == {"a": (1, {1: (9, 4)}), "b": (0, {})}
    assert sel.rows_at(df.where("false"), "id", ["a"], sel.quintile_cuts) == {"a": (0, {})}
    assert sel.quantile(0, {}, 0.8) is None


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 9, 10, 11, 23, 101])
def test_cut_rows_give_the_bins_of_the_ranks(spark, n):
    df = spark.createDataFrame([(i, i // 3) for i in range(n)], "id long, v long")
    cuts = sel.rows_at(df, "id", ["v"], sel.quintile_cuts)["v"][1]
    out = df.select("id", sel.bin_of("v", "id", [cuts[p] for p in sel.quintile_cuts(n)]).alias("cut"),
                    quintile(F.col("id") + 1, F.lit(n)).alias("rank")).collect()
    assert all(r.cut == r["rank"] for r in out)


def test_quantile_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 10 ** 9, 1001)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(x)], "id long, v long")
    for q in (0.0, 0.25, 0.8, 1.0):
        n, rows = sel.rows_at(df, "id", ["v"], lambda n: sel.quantile_positions(n, q), 40)["v"]
        assert sel.quantile(n, rows, q, 1000) == pytest.approx(np.quantile(x / 1000, q), abs=1e-9)


def test_scores_equal_those_of_the_whole_rank(spark):
    base = rf.rfm_base(st.clean_lines(spark, SF_SMALL))
    ranks = multi_rank(base, "CustomerID", {"r": F.col("Recency").cast("bigint"), "f": F.col("Frequency").cast("bigint"),
                                            "m": F.col("Monetary_exact").cast("bigint")})
    n = F.col("_n")
    want = ranks.select("CustomerID", (F.lit(6) - quintile(F.col("_rk_r"), n)).cast("int").alias("R_Score"),
                        quintile(F.col("_rk_f"), n).alias("F_Score"), quintile(F.col("_rk_m"), n).alias("M_Score"))
    got = rf.rfm_scores(base, sample=50).select("CustomerID", "R_Score", "F_Score", "M_Score")
    assert sorted(got.collect()) == sorted(want.collect())
