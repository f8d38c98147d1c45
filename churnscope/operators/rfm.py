"""RFM step: per-customer aggregates (A1-A9), quintile scores (T1-T7),
segments and labels (L1-L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.config import DEFAULT, Params
from churnscope.functions.columns import UNITS, elapsed_days, money, safe_div
from churnscope.functions.rules import segment_of
from churnscope.operators import selection as sel
from churnscope.operators.ranking import materialize, multi_rank

RFM_COLUMNS = ["CustomerID", "Recency", "Frequency", "Monetary", "R_Score",
               "F_Score", "M_Score", "RFM_Score", "Segment", "is_churned",
               "is_high_value", "avg_order_value", "customer_lifetime_days",
               "avg_purchase_interval"]


def analysis_date(clean: DataFrame) -> DataFrame:
    """A1: one row, ``analysis_date`` = last invoice time + 1 day.

    A global max is partial-aggregated per task, so only one value per
    task reaches the final aggregate."""
    return clean.agg((F.max("InvoiceDate") + F.expr("INTERVAL 1 DAY"))
                     .cast("timestamp_ntz").alias("analysis_date"))


def rfm_base(clean: DataFrame, ad: DataFrame | None = None) -> DataFrame:
    """A2-A7 in one per-customer aggregate (the lifetime "merge" of the
    original becomes two more aggregate columns, no join).

    Keeps the exact sum in integer millionths as ``Monetary_exact`` for ranking. Without
    ``ad`` the analysis date is taken from the per-customer last purchase
    (the same aggregate, its exchange reused) instead of another scan."""
    base = clean.groupBy("CustomerID").agg(
        F.max("InvoiceDate").alias("_last"),
        F.min("InvoiceDate").alias("_first"),
        F.count_distinct("InvoiceNo").alias("Frequency"),
        F.sum("amount_units").alias("Monetary_exact"))
    if ad is None:
        ad = base.agg((F.max("_last") + F.expr("INTERVAL 1 DAY"))
                      .cast("timestamp_ntz").alias("analysis_date"))
    # one-row scalar: broadcasting it is bounded by construction
    base = base.crossJoin(F.broadcast(ad))
    lifetime = elapsed_days(F.col("_first"), F.col("_last"))
    return base.select(
        "CustomerID",
        elapsed_days(F.col("_last"), F.col("analysis_date")).alias("Recency"),
        "Frequency",
        money(F.col("Monetary_exact")).alias("Monetary"),
        "Monetary_exact",
        safe_div(money(F.col("Monetary_exact")), F.col("Frequency").cast("double"))
        .alias("avg_order_value"),
        lifetime.alias("customer_lifetime_days"),
        F.when(F.col("Frequency") > 1,
               lifetime.cast("double") / (F.col("Frequency") - 1).cast("double"))
        .alias("avg_purchase_interval"),
        F.col("_first").alias("first_purchase"),
        F.col("_last").alias("last_purchase"),
        "analysis_date",
    )


METRICS = {"R_Score": "Recency", "F_Score": "Frequency", "M_Score": "Monetary_exact"}


def rfm_scores(base: DataFrame, num_partitions: int | None = None, q: float = DEFAULT.hv_quantile,
               sample: int = 20_000) -> DataFrame:
    """Quintile bins in the order (value, CustomerID), and the ``q``
    quantile of Monetary as ``_hv_threshold``.

    R is reversed (most recent = 5). The customer table is written once; the four
    cut rows of each metric and the two rows of the quantile are selected
    (``operators.selection``), so no row is sorted or shuffled. ``num_partitions``
    is that of the written table."""
    long = [F.col(c).cast("bigint").alias(c) if c in METRICS.values() else F.col(c) for c in base.columns]
    base = base.select(*long)
    base = materialize(base.repartition(num_partitions) if num_partitions else base, "rfm-base")
    found = sel.rows_at(base, "CustomerID", list(METRICS.values()),
                        lambda n: sel.quintile_cuts(n) + sel.quantile_positions(n, q), sample)
    score = {}
    for name, c in METRICS.items():
        n, rows = found[c]
        score[name] = sel.bin_of(c, "CustomerID", [rows[p] for p in sel.quintile_cuts(n)])
    threshold = sel.quantile(*found["Monetary_exact"], q, UNITS)
    return (base.withColumn("R_Score", (F.lit(6) - score["R_Score"]).cast("int"))
            .withColumn("F_Score", score["F_Score"])
            .withColumn("M_Score", score["M_Score"])
            .withColumn("RFM_Score", F.concat(F.col("R_Score").cast("string"),
                                              F.col("F_Score").cast("string"),
                                              F.col("M_Score").cast("string")))
            .withColumn("_hv_threshold", F.lit(threshold).cast("double")))


def recency_rank(base: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Every customer's position by Recency, ties by CustomerID (a rank of
    all rows, which the scores don't need)."""
    return multi_rank(base.select("CustomerID", "Recency"), "CustomerID", {"r": F.col("Recency").cast("bigint")},
                      num_partitions=num_partitions).select("CustomerID", F.col("_rk_r").alias("recency_rank"))


def assign_segment(df: DataFrame) -> DataFrame:
    """L1."""
    return df.withColumn("Segment", segment_of(F.col("R_Score"), F.col("F_Score"),
                                               F.col("M_Score")))


def label_churn(df: DataFrame, days: int = DEFAULT.churn_days) -> DataFrame:
    """L2: churned when Recency > ``days``."""
    return df.withColumn("is_churned", (F.col("Recency") > days).cast("int"))


def flag_high_value(scored: DataFrame) -> DataFrame:
    """Monetary at or above the quantile that ``rfm_scores`` selected."""
    return scored.withColumn("is_high_value", (F.col("Monetary") >= F.col("_hv_threshold")).cast("int"))


def rfm_table(clean: DataFrame, params: Params = DEFAULT,
              keep_internal: bool = False,
              num_partitions: int | None = None) -> DataFrame:
    """The full RFM table (14 contract columns, one row per customer)."""
    scored = rfm_scores(rfm_base(clean), num_partitions, params.hv_quantile)
    out = flag_high_value(label_churn(assign_segment(scored), params.churn_days))
    if keep_internal:
        return out
    return out.select(*RFM_COLUMNS)


def population_stats(rfm: DataFrame) -> DataFrame:
    """Population means (and exact medians, distributed) of AOV,
    purchase interval and R/F/M; one row."""
    from churnscope.operators.ranking import exact_quantiles
    means = rfm.agg(
        F.avg("avg_order_value").alias("mean_aov"),
        F.avg("avg_purchase_interval").alias("mean_purchase_interval"),
        (F.sum("Recency").cast("double") / F.count(F.lit(1))).alias("mean_recency"),
        (F.sum("Frequency").cast("double") / F.count(F.lit(1))).alias("mean_frequency"),
        F.avg("Monetary").alias("mean_monetary"),
        F.avg("is_churned").alias("churn_rate"))
    med = exact_quantiles(rfm, "avg_order_value", [0.5]).select(F.col("q_0").alias("median_aov"))
    return means.crossJoin(med)


def score_distribution(rfm: DataFrame) -> DataFrame:
    """Customers per score value for R, F and M (unpivot + pivot)."""
    long = rfm.select("CustomerID", "R_Score", "F_Score", "M_Score").unpivot(
        "CustomerID", ["R_Score", "F_Score", "M_Score"], "metric", "score")
    return (long.groupBy("score").pivot("metric", ["R_Score", "F_Score", "M_Score"])
            .agg(F.count(F.lit(1)))
            .select(F.col("score").cast("int").alias("score"),
                    F.coalesce(F.col("R_Score"), F.lit(0)).cast("bigint").alias("recency_customers"),
                    F.coalesce(F.col("F_Score"), F.lit(0)).cast("bigint").alias("frequency_customers"),
                    F.coalesce(F.col("M_Score"), F.lit(0)).cast("bigint").alias("monetary_customers")))
