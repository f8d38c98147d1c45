"""Derived columns (D1-D9), the customer feature tables (J2) and the
feature matrix clean-up (P8-P9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.config import DEFAULT, Params
from churnscope.functions.columns import elapsed_days, nan_free, true_or_false
from churnscope.functions.rules import segment_risk_level, segment_value_code
from churnscope.operators import sequences as seq

C = "CustomerID"

# The feature lists of the two modelling steps, in order.
TS_MODEL_FEATURES = [
    "Frequency", "Monetary", "F_Score", "M_Score",
    "FM_Score", "RFM_Score_Sum", "avg_order_value",
    "total_transactions", "unique_purchase_days",
    "avg_days_between_purchases", "std_days_between_purchases",
    "min_days_between_purchases", "max_days_between_purchases",
    "purchase_interval_trend", "purchase_amount_trend",
    "amount_trend_ratio", "frequency_trend", "frequency_acceleration",
    "purchase_regularity", "monetary_velocity",
    "recent_activity_ratio_30d", "recent_activity_ratio_60d", "recent_activity_ratio_90d",
    "recent_monetary_ratio_30d", "recent_monetary_ratio_60d", "recent_monetary_ratio_90d",
    "weekend_purchase_ratio", "month_diversity",
    "unique_products", "avg_products_per_order",
    "interval_risk", "activity_risk", "monetary_risk", "risk_score",
    "Segment_Encoded",
    "is_high_value", "lifetime_value_per_day", "purchase_efficiency",
]

CH_MODEL_FEATURES = [
    "Frequency", "Monetary", "F_Score", "M_Score",
    "FM_Score", "F_Score_squared", "M_Score_squared",
    "customer_value_score", "avg_order_value",
    "total_transactions", "unique_purchase_days", "unique_products",
    "avg_days_between_purchases", "std_days_between_purchases",
    "purchase_interval_trend", "monetary_trend", "frequency_trend",
    "purchase_regularity",
    "recent_activity_ratio_30d", "recent_activity_ratio_60d", "recent_activity_ratio_90d",
    "recent_monetary_ratio_30d", "recent_monetary_ratio_60d", "recent_monetary_ratio_90d",
    "interval_risk", "activity_risk", "monetary_risk", "frequency_risk", "risk_score",
    "segment_risk_level", "is_high_value",
    "lifetime_value_per_day",
]


def _flag(cond):
    return true_or_false(cond).cast("int")


def derive_ts(data: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """D1-D5 + L3 + L2 on ``rfm ⟕ ts features``."""
    r, f, m = F.col("R_Score"), F.col("F_Score"), F.col("M_Score")
    life = elapsed_days(F.col("first_purchase"), F.col("analysis_date"))
    out = (data
           .withColumn("RF_Score", r * f).withColumn("RM_Score", r * m)
           .withColumn("FM_Score", f * m).withColumn("RFM_Score_Sum", r + f + m)
           .withColumn("customer_lifetime_days", life)
           .withColumn("lifetime_value_per_day",
                       F.col("Monetary") / (F.col("customer_lifetime_days") + 1).cast("double"))
           .withColumn("purchase_efficiency",
                       F.col("Monetary") / (F.col("Frequency").cast("double")
                                            * F.col("avg_days_between_purchases") + 1.0))
           .withColumn("interval_risk", _flag(F.col("purchase_interval_trend")
                                              > F.col("avg_days_between_purchases")))
           .withColumn("activity_risk", _flag(F.col("recent_activity_ratio_30d") < 0.1))
           .withColumn("monetary_risk", _flag(F.col("amount_trend_ratio") < -0.3)))
    return (out.withColumn("risk_score", F.col("interval_risk") + F.col("activity_risk")
                           + F.col("monetary_risk"))
            .withColumn("Segment_Encoded", segment_value_code(F.col("Segment")))
            .withColumn("is_churned", (F.col("Recency") > params.churn_days).cast("int")))


def derive_ch(data: DataFrame) -> DataFrame:
    """D6-D9 + L4 on ``rfm ⟕ integrated features`` (keeps ``is_churned``)."""
    f, m = F.col("F_Score"), F.col("M_Score")
    life = elapsed_days(F.col("first_purchase"), F.col("analysis_date"))
    out = (data
           .withColumn("FM_Score", f * m)
           .withColumn("F_Score_squared", f * f).withColumn("M_Score_squared", m * m)
           .withColumn("interval_risk", _flag(F.col("purchase_interval_trend") > 10))
           .withColumn("activity_risk", _flag(F.col("recent_activity_ratio_30d") < 0.1))
           .withColumn("monetary_risk", _flag(F.col("monetary_trend") < -0.3))
           .withColumn("frequency_risk", _flag(F.col("frequency_trend") < -0.3)))
    return (out.withColumn("risk_score", F.col("interval_risk") + F.col("activity_risk")
                           + F.col("monetary_risk") + F.col("frequency_risk"))
            .withColumn("segment_risk_level", segment_risk_level(F.col("Segment")))
            .withColumn("customer_value_score", f.cast("double") * 0.3 + m.cast("double") * 0.7)
            .withColumn("avg_order_value",
                        F.col("Monetary") / (F.col("Frequency") + 1).cast("double"))
            .withColumn("lifetime_days", life)
            .withColumn("lifetime_value_per_day",
                        F.col("Monetary") / (F.col("lifetime_days") + 1).cast("double")))


def feature_table(rfm_internal: DataFrame, stats: DataFrame, kind: str = "ts",
                  params: Params = DEFAULT) -> DataFrame:
    """``rfm ⟕ sequence features`` plus derived columns, one row per
    customer. ``rfm_internal`` is ``rfm_table(..., keep_internal=True)``."""
    base = rfm_internal.select(*rfm_internal_columns())
    if kind == "ts":
        feats = seq.features_ts(stats, params.all_windows)
        return derive_ts(base.join(feats, C, "left"), params)
    feats = seq.features_ch(stats, params.all_windows)
    return derive_ch(base.join(feats, C, "left"))


def rfm_internal_columns() -> list[str]:
    from churnscope.operators.rfm import RFM_COLUMNS
    return RFM_COLUMNS + ["Monetary_exact", "first_purchase", "last_purchase", "analysis_date"]


def model_frame(features: DataFrame, kind: str = "ts", params: Params = DEFAULT) -> DataFrame:
    """The model input: key, label, segment and the cleaned feature columns
    (as double)."""
    present = [c for c in feature_names(kind, params) if c in features.columns]
    return features.select(
        C, "Segment", "is_churned", "Recency",
        *[nan_free(F.col(c)).alias(c) for c in present])


def feature_names(kind: str = "ts", params: Params = DEFAULT) -> list[str]:
    """The model's features; the look-back ratios follow ``params.windows``."""
    names, seen = [], set()
    for f in TS_MODEL_FEATURES if kind == "ts" else CH_MODEL_FEATURES:
        stem = next((r for r in ("recent_activity_ratio_", "recent_monetary_ratio_") if f.startswith(r)), None)
        if stem is None:
            names.append(f)
        elif stem not in seen:
            seen.add(stem)
            names += [f"{stem}{d}d" for d in params.windows]
    return names


__all__ = ["derive_ts", "derive_ch", "feature_table",
           "model_frame", "feature_names", "TS_MODEL_FEATURES",
           "CH_MODEL_FEATURES"]
