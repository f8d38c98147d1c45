"""Properties of the RFM and feature tables on the orders fixture."""

import pytest
from pyspark.sql import functions as F

from churnscope.operators import clean as cl
from churnscope.operators import rfm as rf
from churnscope.plans import steps as st
from churnscope.sources import transactions_from_orders
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def clean(spark):
    return cl.valid_sales(transactions_from_orders(spark, SF_SMALL, with_country=False))


def test_scores_invariant_under_partitioning(spark, clean):
    a = rf.rfm_scores(rf.rfm_base(clean), num_partitions=3)
    b = rf.rfm_scores(rf.rfm_base(clean.repartition(11)), num_partitions=11)
    cols = ["CustomerID", "R_Score", "F_Score", "M_Score"]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_quintile_sizes(spark, clean):
    t = rf.rfm_table(clean)
    n = t.count()
    sizes = {r.F_Score: r["count"] for r in t.groupBy("F_Score").count().collect()}
    # qcut on ranks: bins differ in size by at most one
    assert sum(sizes.values()) == n and max(sizes.values()) - min(sizes.values()) <= 1


def test_churned_have_no_recent_activity(spark):
    data = st.feature_table(spark, SF_SMALL, "ts")
    bad = data.filter((F.col("is_churned") == 1) & (
        (F.col("recent_activity_ratio_90d") != 0) | (F.col("recent_monetary_ratio_90d") != 0)))
    assert bad.count() == 0


def test_high_value_share_is_top_fifth(spark, clean):
    t = rf.rfm_table(clean)
    n, hv = t.count(), t.filter(F.col("is_high_value") == 1).count()
    assert abs(hv - 0.2 * n) <= 1
