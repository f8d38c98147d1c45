"""End-to-end RFM step on a generic transaction table, with written outputs."""

import os
import tempfile

from churnscope.plans.pipeline import run
from churnscope.sources import read_written, transactions_from_orders
from tests.conftest import SF_SMALL


def test_rfm_step_writes_outputs(spark):
    out = tempfile.mkdtemp(prefix="cs-out-")
    tx = transactions_from_orders(spark, SF_SMALL, with_country=True)
    outputs = run(spark, tx, out, steps=("rfm",))
    assert set(outputs) == {"rfm_analysis_results", "segment_summary", "high_risk_customers", "profile"}
    rfm = read_written(spark, os.path.join(out, "rfm_analysis_results"))
    summary = read_written(spark, os.path.join(out, "segment_summary"))
    assert rfm.count() == summary.agg({"Customer_Count": "sum"}).first()[0]
    assert len(rfm.columns) == 14


def test_time_series_step_outputs(spark):
    tx = transactions_from_orders(spark, SF_SMALL, with_country=False)
    out = tempfile.mkdtemp(prefix="cs-out-")
    outputs = run(spark, tx, out, steps=("ts",))
    assert os.path.exists(os.path.join(out, "models", "ts", "metadata"))
    assert {"campaign_roi", "early_warning", "segment_actions", "confusion"} <= set(os.listdir(out))
    assert {"churn_predictions", "model_performance", "feature_importance",
            "segment_risk_analysis", "high_risk_customers_prediction"} <= set(outputs)
    perf = outputs["model_performance"].collect()
    assert [r.Model for r in perf] == ["Logistic Regression", "Random Forest", "Gradient Boosting"]
    preds = outputs["churn_predictions"]
    assert preds.count() == outputs["segment_risk_analysis"].agg({"CustomerID_count": "sum"}).first()[0]
