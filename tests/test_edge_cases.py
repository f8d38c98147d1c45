"""Hand-made edge rows (fixture E) through cleaning, RFM and the three
feature families."""

import pytest
from pyspark.sql import functions as F

from churnscope.operators import clean as cl
from churnscope.operators import rfm as rf
from churnscope.operators import sequences as sq
from churnscope.sources import edge_transactions


@pytest.fixture(scope="module")
def edge(spark):
    tx = edge_transactions(spark)
    clean = cl.valid_sales(tx)
    ad = rf.analysis_date(clean)
    stats = sq.sequence_stats(clean, ad)
    return {
        "tx": tx, "clean": clean,
        "rfm": {r.CustomerID: r for r in rf.rfm_table(clean).collect()},
        "ts": {r.CustomerID: r for r in sq.features_ts(stats).collect()},
        "ch": {r.CustomerID: r for r in sq.features_ch(stats).collect()},
        "w": {r.CustomerID: r for r in sq.half_trends(stats).collect()},
    }


def test_cleaning(edge):
    clean = edge["clean"]
    ids = {r.CustomerID for r in clean.select("CustomerID").distinct().collect()}
    assert None not in ids                                   # null customer dropped
    assert clean.filter(F.col("InvoiceNo") == "12C4").count() == 0   # 'C' anywhere = return
    assert clean.filter(F.col("InvoiceNo").isNull()).count() == 1    # null invoice is a sale
    assert clean.filter(F.col("CustomerID") == 6).count() == 1       # zero price / negative qty


def test_frequency_ignores_null_invoice(edge):
    assert edge["rfm"][5].Frequency == 1
    assert edge["ts"][5].total_transactions == 2


def test_single_line_defaults(edge):
    ts, ch, w = edge["ts"][1], edge["ch"][1], edge["w"][1]
    assert ts.avg_days_between_purchases is None and ts.purchase_interval_trend == 0
    assert ts.unique_products is None and ts.recent_activity_ratio_30d == 0
    assert ch.avg_days_between_purchases == 999 and ch.std_days_between_purchases == 0
    assert ch.unique_products == 1
    assert (w.frequency_trend, w.monetary_trend, w.interval_trend) == (0, 0, 0)


def test_same_instant(edge):
    w, ch = edge["w"][2], edge["ch"][2]
    assert w.frequency_trend == -1.0 and w.monetary_trend == -1.0   # zero span: all in first half
    assert ch.frequency_trend == 0 and ch.monetary_trend == 0        # integrated step needs span > 0


def test_one_day_many_lines(edge):
    assert edge["ts"][3].avg_days_between_purchases == 0
    assert edge["ch"][3].avg_days_between_purchases == 999


def test_elapsed_versus_calendar(edge):
    assert edge["ts"][4].avg_days_between_purchases == 1.0     # calendar dates
    assert edge["ch"][4].avg_days_between_purchases == 0.0     # elapsed whole days
    assert edge["ch"][4].purchase_regularity == 0.0
    assert edge["rfm"][4].customer_lifetime_days == 0


def test_ties_broken_by_customer(edge):
    f = [edge["rfm"][100 + i].F_Score for i in range(7)]
    assert f == sorted(f)


def test_ratios_ordered(edge):
    for r in edge["ts"].values():
        assert r.recent_activity_ratio_30d <= r.recent_activity_ratio_60d <= r.recent_activity_ratio_90d


def test_profile_counts(edge):
    p = cl.profile(edge["tx"]).first()
    assert (p.raw_rows, p.null_customers, p.raw_customers) == (22, 1, 13)
    assert (p.negative_quantity, p.nonpositive_price, p.return_lines, p.return_customers) == (1, 1, 1, 1)
    assert (p.valid_rows, p.valid_customers, p.removed_rows) == (18, 13, 1)
