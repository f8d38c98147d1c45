"""The analysis end to end on any transaction table, writing the same
result tables as the original scripts (S6-S14).

    from churnscope.plans.pipeline import run
    run(spark, tx, "/shared/out", steps=("rfm", "ts", "ch"))
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnscope.config import DEFAULT, Params
from churnscope.operators import campaign as cp
from churnscope.operators import clean as cl
from churnscope.operators import features as ft
from churnscope.operators import metrics as mt
from churnscope.operators import reports as rp
from churnscope.operators import rfm as rf
from churnscope.operators import sequences as sq
from churnscope.operators.ranking import intermediates, materialize
from churnscope.plans import modeling as mdl
from churnscope.session import size_shuffles, tune
from churnscope.sources import write_table


def prepare(tx: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Valid sales (optional country scope), written once. Shuffles are
    sized from the input's size first."""
    tune(tx.sparkSession)
    size_shuffles(tx.sparkSession, tx)
    return materialize(cl.valid_sales(tx, params.country), "clean")


def rfm_step(clean: DataFrame, params: Params = DEFAULT) -> dict[str, DataFrame]:
    """RFM step outputs: the customer table, segment summary (by segment),
    the high-risk list (Monetary descending)."""
    table = rf.rfm_table(clean, params, keep_internal=True)
    return {
        "rfm_analysis_results": table.select(*rf.RFM_COLUMNS),
        "segment_summary": rp.segment_summary(table).orderBy("Segment"),
        "high_risk_customers": rp.high_risk_list(table, params.high_risk_segments),
        "_internal": table,
    }


def feature_tables(clean: DataFrame, rfm_internal: DataFrame,
                   params: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    stats = materialize(sq.sequence_stats(clean, None, params.all_windows), "stats")
    ts = materialize(ft.feature_table(rfm_internal, stats, "ts", params), "ts")
    ch = materialize(ft.feature_table(rfm_internal, stats, "ch", params), "ch")
    return ts, ch


def ts_step(ts_table: DataFrame, params: Params = DEFAULT) -> tuple[dict[str, DataFrame], mdl.StepResult]:
    res = mdl.ts_models(ts_table, params)
    return {
        "churn_predictions": mdl.predictions_export(res),
        "high_risk_customers_prediction": mdl.high_risk_export(res, "ts", params.high_risk_probability),
        "model_performance": res.results,
        "feature_importance": res.importance,
        "segment_risk_analysis": rp.segment_risk_file(res.predictions, "ts").orderBy("Segment"),
        "confusion": mt.confusion(res.test_scores, pred="predicted"),
        "campaign_roi": cp.campaign_roi(res.predictions, params=params, value_scope="all"),
        "early_warning": rp.early_warning(res.predictions),
        "segment_actions": rp.segment_actions(res.predictions),
    }, res


def ch_step(ch_table: DataFrame, params: Params = DEFAULT) -> tuple[dict[str, DataFrame], mdl.StepResult]:
    res = mdl.ch_models(ch_table, params)
    return {
        "churn_predictions_final": mdl.predictions_export(res),
        "high_risk_customers_final": mdl.high_risk_export(res, "ch", params.high_risk_probability),
        "model_performance_final": res.summary,
        "feature_importance_final": res.importance,
        "segment_risk_analysis_final": rp.segment_risk_file(res.predictions, "ch").orderBy("Segment"),
        "tier_summary": rp.tier_summary(res.predictions),
        "confusion_final": mt.confusion(res.test_scores, pred="predicted"),
        "high_risk_totals": rp.high_risk_totals(res.predictions, threshold=params.high_risk_probability),
        "early_warning_final": rp.early_warning(res.predictions),
        "campaign_roi_final": cp.campaign_roi(res.predictions, params=params, value_scope="active"),
        "roi_curve": cp.roi_curve(res.predictions, params),
    }, res


def run(spark: SparkSession, tx: DataFrame, out: str | None = None,
        steps=("rfm", "ts", "ch"), params: Params = DEFAULT, fmt: str = "parquet",
        cleanup: bool = False) -> dict:
    """Run the chosen steps; write every output table under ``out``, and the
    scoring model of each modelling step under ``out/models``. With ``cleanup``
    (only together with ``out``) the files that this run wrote to the
    checkpoint folder are deleted afterwards; the returned DataFrames must then
    not be used."""
    with intermediates(spark, remove=bool(out and cleanup)):
        clean = prepare(tx, params)
        outputs: dict[str, DataFrame] = {}
        r = rfm_step(clean, params)
        internal = r.pop("_internal")
        models = {}
        if "rfm" in steps:
            outputs.update(r)
            outputs["profile"] = cl.profile(tx)
        if "ts" in steps or "ch" in steps:
            ts_table, ch_table = feature_tables(clean, internal, params)
            if "ts" in steps:
                made, models["ts"] = ts_step(ts_table, params)
                outputs.update(made)
            if "ch" in steps:
                made, models["ch"] = ch_step(ch_table, params)
                outputs.update(made)
        if out:
            root = out.rstrip("/")
            for name, df in outputs.items():
                write_table(df.coalesce(1) if _small(name) else df, f"{root}/{name}", fmt)
            for name, result in models.items():
                mdl.save_step(result, f"{root}/models/{name}")
    return outputs


def _small(name: str) -> bool:
    """Report tables with a bounded number of rows (one per segment, tier,
    model or feature) are written as a single file."""
    return name in {"segment_summary", "model_performance", "feature_importance",
                    "segment_risk_analysis", "model_performance_final",
                    "feature_importance_final", "segment_risk_analysis_final", "tier_summary",
                    "confusion", "confusion_final", "campaign_roi", "campaign_roi_final", "roi_curve",
                    "high_risk_totals", "segment_actions", "profile"}


