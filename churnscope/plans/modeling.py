"""The two modelling steps end to end (E1-E11 with M1-M6, T8, C2)."""

from __future__ import annotations

import statistics
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.config import DEFAULT, Params
from churnscope.operators import campaign as cp
from churnscope.operators import models as md
from churnscope.operators import reports as rp
from churnscope.operators.features import feature_names, model_frame
from churnscope.operators.ranking import materialize
from churnscope.plans import steps as st
from churnscope.sources.writers import load_model, save_model

# The columns of the predictions file, in order.
PREDICTION_COLUMNS = ["CustomerID", "Segment", "Recency", "Frequency", "Monetary",
                      "is_churned", "churn_probability", "risk_level"]


@dataclass
class StepResult:
    results: DataFrame          # per-model metrics table
    best: str
    predictions: DataFrame      # all customers with probability and tier
    importance: DataFrame       # Feature, Importance (descending), Coefficient
    members: list[md.Fitted]    # the model that scores, or the voting members
    features: list[str]
    performance: dict           # test metrics of the chosen model
    frame: DataFrame            # model input of every customer, with its split
    summary: DataFrame | None = None   # integrated step: one-row final table
    test_scores: DataFrame | None = None  # best model on the test split
    scores: dict[str, DataFrame] | None = None  # scores of every customer by model
    threshold: float = 0.5


IMPORTANCE = "Feature string, Importance double, Coefficient double"
TEST_COLUMNS = ["CustomerID", "is_churned", "churn_probability", "predicted"]


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _with_tier(data: DataFrame, scores: DataFrame) -> DataFrame:
    """Every customer's row with probability and tier, written once: each
    output of a step reads it."""
    joined = data.join(scores.select("CustomerID", "churn_probability"), "CustomerID")
    return materialize(rp.with_risk_tier(joined), "predictions")


def ts_step(spark: SparkSession, sf_dir: str, source: str = "orders") -> StepResult:
    """Time-series step: three models, best by *test* AUC (strict >)."""
    key = ("ts_step", sf_dir, source)
    return st._memo(spark, key, lambda: ts_models(st.feature_table(spark, sf_dir, "ts", source), st.params_for(source)))


def ts_models(data: DataFrame, params: Params = DEFAULT) -> StepResult:
    """The time-series step on a TS feature table (``feature_table(.., 'ts')``)."""
    spark = data.sparkSession
    feats = feature_names("ts", params)
    tr = md.Trainer(model_frame(data, "ts", params), feats, params.seed, params.split_fractions)
    rows, best, best_auc, fitted_best, best_test = [], None, 0.0, None, {}
    all_fitted = tr.fit_all(md.TS_SPECS)
    scored = md.parallel(tr.score_all, all_fitted)
    # validation and test metrics of every model, evaluated concurrently
    jobs = [md.part(s, part) for s in scored for part in ("val", "test")]
    metrics = md.parallel(md.evaluate, jobs, threads=6)
    for i, (spec, fitted) in enumerate(zip(md.TS_SPECS, all_fitted)):
        v, t = metrics[2 * i], metrics[2 * i + 1]
        rows.append((spec.name, v["auc"], t["auc"], t["precision"], t["recall"], t["f1"]))
        if t["auc"] is not None and t["auc"] > best_auc:
            best, best_auc, fitted_best, best_test = spec.name, t["auc"], i, t
    results = _rows(spark, rows, "Model string, Val_AUC double, Test_AUC double, "
                                 "Precision double, Recall double, F1 double")
    chosen = scored[fitted_best]
    imp = _rows(spark, md.importances(all_fitted[fitted_best], feats), IMPORTANCE)
    return StepResult(results, best, _with_tier(data, chosen), imp, [all_fitted[fitted_best]], feats, best_test, tr.frame,
                      test_scores=md.part(chosen, "test").select(*TEST_COLUMNS),
                      scores={s.name: x for s, x in zip(md.TS_SPECS, scored)})


def ch_step(spark: SparkSession, sf_dir: str, source: str = "orders") -> StepResult:
    """Integrated step: five models, soft vote of the top 3 by validation
    AUC, best by validation AUC (first wins ties), test metrics, k-fold
    CV of the chosen model, ROI sweep, one-row summary."""
    key = ("ch_step", sf_dir, source)
    return st._memo(spark, key, lambda: ch_models(st.feature_table(spark, sf_dir, "ch", source), st.params_for(source)))


def ch_models(data: DataFrame, params: Params = DEFAULT) -> StepResult:
    """The integrated step on a CH feature table (``feature_table(.., 'ch')``)."""
    spark = data.sparkSession
    feats = feature_names("ch", params)
    tr = md.Trainer(model_frame(data, "ch", params), feats, params.seed, params.split_fractions)
    names = [s.name for s in md.CH_SPECS]
    fitted = dict(zip(names, tr.fit_all(md.CH_SPECS)))
    scores = dict(zip(names, md.parallel(lambda n: tr.score_all(fitted[n]), names, threads=5)))
    aucs = md.parallel(lambda n: md.evaluate(md.part(scores[n], "val"))["auc"], names, threads=5)
    val_auc = dict(zip(names, aucs))
    top = sorted(val_auc, key=lambda n: -val_auc[n])[:3]
    # a member fitted on synthetic rows votes with a fit on the real ones
    voters = [tr.voter(fitted[n]) for n in top]
    votes = [scores[n] if v is fitted[n] else tr.score_all(v) for n, v in zip(top, voters)]
    scores["Ensemble"] = materialize(md.soft_vote(votes), "vote")
    by_model = dict(val_auc) | {"Ensemble": md.evaluate(md.part(scores["Ensemble"], "val"))["auc"]}
    best = max(by_model, key=lambda n: by_model[n])        # first of equal maxima
    members = voters if best == "Ensemble" else [fitted[best]]

    test = md.evaluate(md.part(scores[best], "test"))
    fold_auc = md.cross_validate(tr.frame, [m.spec for m in members], feats, params.cv_folds, params.seed,
                                 weight_of_positives=md.pos_weight(tr.train))
    preds = _with_tier(data, scores[best])
    roi = cp.best_threshold(preds, params, value_scope="active").first()
    if best != "Ensemble":
        imp_rows = md.importances(members[0], feats)
    else:
        trees = [m for m in members if m.spec.kind != "lr"]
        acc = {f: 0.0 for f in feats}
        for t in trees:
            for f, v, _ in md.importances(t, feats):
                acc[f] += v / max(len(trees), 1)
        imp_rows = sorted(((f, v, None) for f, v in acc.items()), key=lambda t: (-t[1], feats.index(t[0])))
    summary = _rows(spark, [(best, by_model[best], test["auc"], test["precision"], test["recall"],
                             test["f1"], statistics.fmean(fold_auc), statistics.pstdev(fold_auc), min(fold_auc), max(fold_auc),
                             float(roi["threshold"]), None if roi["roi"] is None else float(roi["roi"]))],
                    "Model string, Validation_AUC double, Test_AUC double, Test_Precision double, "
                    "Test_Recall double, Test_F1 double, CV_Mean_AUC double, CV_Std_AUC double, "
                    "CV_Min_AUC double, CV_Max_AUC double, "
                    "Optimal_ROI_Threshold double, Expected_ROI double")
    results = _rows(spark, [(n, float(s)) for n, s in by_model.items()],
                    "Model string, Validation_AUC double")
    imp = _rows(spark, imp_rows, IMPORTANCE)
    return StepResult(results, best, preds, imp, members, feats, test, tr.frame, summary,
                      md.part(scores[best], "test").select(*TEST_COLUMNS),
                      {**scores, **{f"vote:{n}": v for n, v in zip(top, votes)}}, float(roi["threshold"]))


def save_step(result: StepResult, path: str) -> None:
    """The scoring model of a step: its members, which score raw rows, and
    what is needed to use them."""
    spark = result.results.sparkSession
    save_model([(m.spec.name, m.model) for m in result.members], path, result.features, result.best, result.threshold,
               result.performance, spark)


def score_saved(spark: SparkSession, path: str, frame: DataFrame) -> DataFrame:
    """CustomerID and churn_probability of ``frame`` (a model frame) by a
    saved model: the mean over its members."""
    models, _ = load_model(spark, path)
    scored = [md.predict(m, frame).select("CustomerID", "is_churned", "churn_probability") for m in models.values()]
    voted = scored[0] if len(scored) == 1 else md.soft_vote(scored)
    return voted.select("CustomerID", "churn_probability")


def high_risk_export(result: StepResult, kind: str = "ts",
                     threshold: float = DEFAULT.high_risk_probability) -> DataFrame:
    """Customers with probability ≥ threshold. The time-series
    step keeps its scoring order and adds the interval trend; the
    integrated step sorts by probability and adds the risk score."""
    base = ["CustomerID", "Segment", "churn_probability", "Recency", "Frequency", "Monetary"]
    x = result.predictions.filter(F.col("churn_probability") >= threshold)
    if kind == "ts":
        return x.select(*base, "recent_activity_ratio_30d", "purchase_interval_trend")
    return x.select(*base, "risk_score", "recent_activity_ratio_30d").orderBy(
        F.desc("churn_probability"), "CustomerID")


def predictions_export(result: StepResult) -> DataFrame:
    """The predictions file, probability descending (distributed sort)."""
    return result.predictions.select(*PREDICTION_COLUMNS).orderBy(
        F.desc("churn_probability"), "CustomerID")
