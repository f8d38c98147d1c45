"""The three analysis steps as lazy plans over a transaction source, with a
per-session memo so that catalog queries sharing the (checkpointed) RFM
table do not rebuild it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.config import DEFAULT, Params
from churnscope.operators import clean as cl
from churnscope.operators import features as ft
from churnscope.operators import rfm as rf
from churnscope.operators import sequences as sq
from churnscope.operators.ranking import materialize
from churnscope.session import tune
from churnscope.sources import transactions_from_events, transactions_from_orders

_MEMO: dict = {}

# fixture B: short history, so the churn label uses a shorter horizon
EVENTS_PARAMS = Params(churn_days=5)


def params_for(source: str) -> Params:
    return EVENTS_PARAMS if source == "events" else DEFAULT


def transactions(spark: SparkSession, sf_dir: str, source: str = "orders",
                 with_country: bool = False) -> DataFrame:
    if source == "events":
        return transactions_from_events(spark, sf_dir)
    return transactions_from_orders(spark, sf_dir, with_country=with_country)


def clean_lines(spark: SparkSession, sf_dir: str, source: str = "orders",
                country: str | None = None) -> DataFrame:
    """The cleaned transaction lines, written once per session as a
    Parquet table in the shared checkpoint folder (the original also hands
    a cleaned file to the later steps). Every later aggregate scans this
    table instead of repeating the joins of the source."""
    def build():
        tx = transactions(spark, sf_dir, source, with_country=country is not None)
        return materialize(cl.valid_sales(tx, country), f"clean-{source}")
    return _memo(spark, ("clean", sf_dir, source, country), build)


def _memo(spark: SparkSession, key: tuple, build):
    k = (id(spark), spark.sparkContext.applicationId) + key
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def rfm_internal(spark: SparkSession, sf_dir: str, source: str = "orders") -> DataFrame:
    """The RFM table with helper columns (ranks, first/last purchase,
    analysis date). Built once per session and source."""
    tune(spark)
    p = params_for(source)
    return _memo(spark, ("rfm", sf_dir, source),
                 lambda: materialize(
                     rf.rfm_table(clean_lines(spark, sf_dir, source), p, keep_internal=True), "rfm"))


def rfm_table(spark: SparkSession, sf_dir: str, source: str = "orders") -> DataFrame:
    return rfm_internal(spark, sf_dir, source).select(*rf.RFM_COLUMNS)


def sequence_stats(spark: SparkSession, sf_dir: str, source: str = "orders") -> DataFrame:
    """Raw per-customer sequence statistics, materialised once per session
    (three feature families and both feature tables read them)."""
    tune(spark)

    def build():
        clean = clean_lines(spark, sf_dir, source)
        return materialize(sq.sequence_stats(clean, None, params_for(source).all_windows), "stats")
    return _memo(spark, ("stats", sf_dir, source), build)


def feature_table(spark: SparkSession, sf_dir: str, kind: str = "ts",
                  source: str = "orders") -> DataFrame:
    """``rfm ⟕ sequence features`` + derived columns, materialised once per
    session: many reports and every model read it."""
    p = params_for(source)

    def build():
        return materialize(ft.feature_table(
            rfm_internal(spark, sf_dir, source), sequence_stats(spark, sf_dir, source), kind, p), f"features-{kind}")
    return _memo(spark, ("features", sf_dir, kind, source), build)


def score_fixture(spark: SparkSession, sf_dir: str, source: str = "orders",
                  kind: str = "ts") -> DataFrame:
    """A deterministic stand-in for a model score, for oracle-checking the
    evaluation, tier and campaign operators without a trained model:
    ``round(1 - recent_activity_ratio_90d, 6)`` on the feature table of the
    ``kind`` step (so every report column is present)."""
    data = feature_table(spark, sf_dir, kind, source)
    score = F.floor((F.lit(1.0) - F.coalesce(F.col("recent_activity_ratio_90d"), F.lit(0.0)))
                    * 1e6 + 0.5) / 1e6
    return data.withColumn("churn_probability", score.cast("double"))
