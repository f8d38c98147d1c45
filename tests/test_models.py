"""A light model test: logistic regression on the small orders fixture."""

from pyspark.sql import functions as F

from churnscope.operators import models as md
from churnscope.operators.features import feature_names, model_frame
from churnscope.plans import steps as st
from tests.conftest import SF_SMALL


def test_logistic_regression_scores(spark):
    data = st.feature_table(spark, SF_SMALL, "ts")
    frame = model_frame(data, "ts")
    tr = md.Trainer(frame, feature_names("ts"))
    fitted = tr.fit(md.TS_SPECS[0])
    scored = tr.score_all(fitted)
    assert scored.count() == frame.count()
    assert scored.filter((F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)).count() == 0
    assert md.evaluate(scored)["auc"] > 0.9
    again = md.Trainer(frame, feature_names("ts"))
    key = ["CustomerID", "split"]
    assert sorted(tr.frame.select(*key).collect()) == sorted(again.frame.select(*key).collect())


def test_the_vote_takes_a_logistic_member_fitted_on_real_rows(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    y = rng.random(400) < 0.2
    rows = [(i, int(c), float(rng.normal() + 2 * c), float(rng.normal())) for i, c in enumerate(y)]
    frame = spark.createDataFrame(rows, "CustomerID long, is_churned int, x1 double, x2 double")
    tr = md.Trainer(frame, ["x1", "x2"])
    fitted = tr.fit(md.CH_SPECS[0])
    voter = tr.voter(fitted)
    assert fitted.smoted and not voter.smoted and tr.voter(voter) is voter
    a, b = (m.model.stages[-1].coefficients.toArray() for m in (fitted, voter))
    assert abs(a - b).max() > 1e-6


def test_saved_model_scores_raw_rows(spark, tmp_path):
    from churnscope.plans import modeling as mdl
    data = st.feature_table(spark, SF_SMALL, "ts")
    frame = model_frame(data, "ts")
    tr = md.Trainer(frame, feature_names("ts"))
    members = [tr.fit(md.TS_SPECS[0]), tr.fit(md.ModelSpec("tree", "gbt", {"maxIter": 3, "maxDepth": 2}))]
    vote = {r.CustomerID: r.churn_probability for r in md.soft_vote([tr.score_all(m) for m in members]).collect()}
    from churnscope.sources import save_model
    save_model([(m.spec.name, m.model) for m in members], str(tmp_path), tr.features, "Ensemble", 0.5, {"auc": 1.0}, spark)
    got = {r.CustomerID: r.churn_probability for r in mdl.score_saved(spark, str(tmp_path), frame).collect()}
    assert got.keys() == vote.keys() and max(abs(got[k] - vote[k]) for k in vote) < 1e-12
    rows = md.importances(members[0], tr.features)
    assert all(v == abs(c) for _, v, c in rows) and any(c < 0 for _, _, c in rows)


def test_windows_and_split_shares_take_effect():
    from churnscope.config import Params
    from churnscope.operators import ml_prep as mp
    import pytest
    names = feature_names("ts", Params(windows=(7, 14)))
    assert [n for n in names if n.startswith("recent_activity")] == ["recent_activity_ratio_7d", "recent_activity_ratio_14d"]
    assert len(feature_names("ch")) == 32 and Params(windows=(7, 14)).all_windows == (7, 14, 30)
    assert mp.split_sizes((0.6, 0.1, 0.3)) == {"test_size": 0.4, "test_share_of_rest": 0.75}
    with pytest.raises(ValueError):
        mp.split_sizes((0.5, 0.1, 0.1))


def test_feature_table_with_other_windows(spark):
    from churnscope.config import Params
    from churnscope.plans import pipeline as pl
    from churnscope.sources import transactions_from_events
    params = Params(churn_days=5, windows=(7, 14))
    clean = pl.prepare(transactions_from_events(spark, SF_SMALL), params)
    ts, ch = pl.feature_tables(clean, pl.rfm_step(clean, params)["_internal"], params)
    assert {"recent_activity_ratio_14d", "activity_risk"} <= set(ts.columns) & set(ch.columns)
    assert "recent_monetary_ratio_7d" in model_frame(ch, "ch", params).columns
