"""Segment rules, quintile bins, tiers and lookups (no data needed)."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnscope.functions import rules


def test_quintile_matches_qcut_on_ranks(spark):
    ns = list(range(2, 160)) + [997, 1000, 1499]
    rows = [(n, r) for n in ns for r in range(1, n + 1)]
    df = spark.createDataFrame(rows, "n long, r long").select(
        "n", "r", rules.quintile(F.col("r"), F.col("n")).alias("q"))
    got = {(x.n, x.r): x.q for x in df.collect()}
    for n in ns:
        expected = pd.qcut(pd.Series(np.arange(1, n + 1)), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
        for r, e in zip(range(1, n + 1), expected):
            assert got[(n, r)] == e, (n, r)


def test_segment_rules_over_all_triples(spark):
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r int, f int, m int").select(
        "r", "f", "m", rules.segment_of(F.col("r"), F.col("f"), F.col("m")).alias("s"))
    seg = {(x.r, x.f, x.m): x.s for x in df.collect()}
    assert seg[(5, 5, 5)] == "Champions"
    assert seg[(3, 3, 3)] == "Loyal Customers"
    assert seg[(4, 1, 1)] == "New Customers"
    assert seg[(3, 1, 3)] == "Promising"
    assert seg[(2, 2, 1)] == "About to Sleep"
    assert seg[(1, 3, 5)] == "At Risk"
    assert seg[(1, 1, 1)] == "Hibernating"
    assert seg[(1, 2, 3)] == "Lost"
    # shadowed by earlier rules: never assigned
    assert "Need Attention" not in seg.values()
    assert "Cannot Lose Them" not in seg.values()
    # At Risk in effect needs r = 1
    assert all(k[0] == 1 for k, v in seg.items() if v == "At Risk")


@pytest.mark.parametrize("p,tier", [(0.0, None), (0.3, "Low"), (0.30001, "Medium"), (0.5, "Medium"),
                                    (0.7, "High"), (0.71, "Very High"), (1.0, "Very High")])
def test_risk_tier_right_closed(spark, p, tier):
    got = spark.range(1).select(rules.risk_tier(F.lit(p)).alias("t")).first().t
    assert got == tier


def test_lookups_defaults(spark):
    df = spark.createDataFrame([("Champions",), ("Lost",), ("Unknown",)], "s string")
    out = df.select(rules.segment_value_code(F.col("s")).alias("v"),
                    rules.segment_risk_level(F.col("s")).alias("r")).collect()
    assert [(x.v, x.r) for x in out] == [(11, 1), (1, 9), (0, 5)]


def test_golden_rows_replay(spark):
    """Rows of the published high-risk list: scores → segment, AOV = M/F,
    interval = lifetime/(F-1)."""
    rows = [(15749, 3, 44534.3, 1, 3, 5, 97), (15098, 3, 39916.5, 1, 3, 5, 0),
            (13093, 8, 7832.47, 1, 5, 5, 97), (17850, 34, 5391.21, 1, 5, 5, 1)]
    df = spark.createDataFrame(rows, "c long, f long, m double, rs int, fs int, ms int, life long")
    out = df.select(rules.segment_of(F.col("rs"), F.col("fs"), F.col("ms")).alias("seg"),
                    (F.col("m") / F.col("f")).alias("aov"),
                    (F.col("life") / (F.col("f") - 1)).alias("itv")).collect()
    assert {x.seg for x in out} == {"At Risk"}
    assert out[0].aov == pytest.approx(14844.766666666668)
    assert out[0].itv == pytest.approx(48.5)
    assert out[3].itv == pytest.approx(0.030303030303030304)
