"""Segment and portfolio reports (R1-R12), lookups with counts (L5-L6),
chart tables (B1-B7) and ranked heads (K1-K4).

Every report is a ``groupBy`` over the customer table (map-side combined)
whose output has at most one row per segment or tier; shares over those
few rows use an un-partitioned window over that small, bounded result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnscope.config import DEFAULT
from churnscope.functions.columns import money, round_even, safe_div, sum_units, true_or_false
from churnscope.functions.rules import ACTION_PLANS, RISK_TIERS, SEGMENT_STRATEGY, risk_tier

def _all():
    return Window.partitionBy()


def _mean(col: str):
    """Mean of an integer column as an exact sum over a count."""
    return F.sum(col).cast("double") / F.count(F.lit(1)).cast("double")


def _revenue():
    """Exact revenue of a group: the sum of exact amounts as currency."""
    return money(sum_units())


def _mean_revenue():
    return money(sum_units()) / F.count(F.lit(1)).cast("double")


def segment_sizes(rfm: DataFrame) -> DataFrame:
    """Customers per segment and share of all customers (%)."""
    g = rfm.groupBy("Segment").agg(F.count(F.lit(1)).alias("customers"))
    return g.withColumn("pct", F.col("customers").cast("double") * 100.0
                        / F.sum("customers").over(_all()).cast("double"))


def churn_totals(rfm: DataFrame) -> DataFrame:
    """R2: churn rate, active and churned counts, class ratio (active per
    churned, NULL when nobody churned)."""
    g = rfm.agg(F.count(F.lit(1)).alias("customers"),
                F.sum("is_churned").cast("bigint").alias("churned"))
    return g.select(
        "customers",
        (F.col("churned").cast("double") / F.col("customers").cast("double")).alias("churn_rate"),
        (F.col("customers") - F.col("churned")).alias("active"), "churned",
        safe_div((F.col("customers") - F.col("churned")).cast("double"),
                 F.col("churned").cast("double")).alias("class_ratio"))


def segment_churn(rfm: DataFrame) -> DataFrame:
    """R3 (+K1 order): churn rate (3 dp) and size per segment."""
    g = rfm.groupBy("Segment").agg(round_even(_mean("is_churned"), 3).alias("Churn_Rate"),
                                   F.count(F.lit(1)).alias("Customer_Count"))
    return g.orderBy(F.desc("Churn_Rate"), "Segment")


def high_value_share(rfm: DataFrame) -> DataFrame:
    """High-value count, % of customers and % of revenue."""
    hv = F.col("is_high_value") == 1
    g = rfm.agg(F.count(F.lit(1)).alias("customers"),
                F.count_if(hv).alias("high_value_customers"),
                F.sum(F.when(hv, F.col("Monetary_exact").cast("decimal(20,0)"))).alias("_hv_rev"),
                sum_units().alias("_rev"))
    return g.select(
        "high_value_customers",
        (F.col("high_value_customers").cast("double") * 100.0
         / F.col("customers").cast("double")).alias("high_value_pct"),
        (money(F.coalesce(F.col("_hv_rev"), F.lit(0).cast("decimal(20,0)"))) * 100.0
         / money(F.col("_rev"))).alias("revenue_share_pct"))


def segment_summary(rfm: DataFrame) -> DataFrame:
    """The segment summary file (2 dp) with Revenue_Contribution (1 dp)
    computed from the already rounded Total_Revenue."""
    g = rfm.groupBy("Segment").agg(
        round_even(_mean("Recency"), 2).alias("Avg_Recency"),
        round_even(_mean("Frequency"), 2).alias("Avg_Frequency"),
        round_even(money(sum_units()) / F.count(F.lit(1)).cast("double"), 2)
        .alias("Avg_Monetary"),
        round_even(money(sum_units()), 2).alias("Total_Revenue"),
        round_even(F.avg("avg_order_value"), 2).alias("Avg_AOV"),
        round_even(_mean("is_churned"), 2).alias("Churn_Rate"),
        F.sum("is_high_value").cast("bigint").alias("High_Value_Count"),
        F.count(F.lit(1)).alias("Customer_Count"),
        sum_units().alias("_rev"))
    total = F.sum("_rev").over(_all())
    return (g.withColumn("Revenue_Contribution",
                         round_even(F.col("Total_Revenue") / money(total) * 100.0, 1))
            .drop("_rev"))


def top_segments_by_revenue(summary: DataFrame, n: int = 3) -> DataFrame:
    """K2: top segments by revenue contribution (ties in key order)."""
    return summary.orderBy(F.desc("Revenue_Contribution"), "Segment").limit(n).select(
        "Segment", "Revenue_Contribution", "Customer_Count")


def at_risk_revenue(rfm: DataFrame, segments=DEFAULT.high_risk_segments) -> DataFrame:
    """Customers and revenue at stake in the at-risk segments."""
    return (rfm.filter(F.col("Segment").isin(*segments)).groupBy("Segment")
            .agg(F.count(F.lit(1)).alias("customers"),
                 money(sum_units()).alias("revenue")))


def high_risk_list(rfm: DataFrame, segments=DEFAULT.high_risk_segments) -> DataFrame:
    """Customers of the at-risk segments, Monetary descending
    (a distributed range sort)."""
    from churnscope.operators.rfm import RFM_COLUMNS
    return (rfm.filter(F.col("Segment").isin(*segments)).select(*RFM_COLUMNS)
            .orderBy(F.desc("Monetary"), "CustomerID"))


def _dim(spark: SparkSession, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def segment_strategy(rfm: DataFrame) -> DataFrame:
    """Strategy text for the segments that have one and occur."""
    spark = rfm.sparkSession
    dim = _dim(spark, list(SEGMENT_STRATEGY.items()), "Segment string, strategy string")
    counts = rfm.groupBy("Segment").agg(F.count(F.lit(1)).alias("customers"))
    # the dimension is a fixed 7-row table
    return counts.join(F.broadcast(dim), "Segment").select("Segment", "customers", "strategy")


def segment_actions(scored: DataFrame, prob: str = "churn_probability") -> DataFrame:
    """Action and tactics per segment with customers and mean
    probability; one row per tactic (``explode``)."""
    spark = scored.sparkSession
    rows = [(s, a, t) for s, (a, t) in ACTION_PLANS.items()]
    dim = _dim(spark, rows, "Segment string, action string, tactics array<string>")
    agg = scored.groupBy("Segment").agg(F.count(F.lit(1)).alias("customers"),
                                        F.avg(prob).alias("mean_probability"))
    return (agg.join(F.broadcast(dim), "Segment")
            .select("Segment", "customers", "mean_probability", "action",
                    F.posexplode("tactics").alias("tactic_no", "tactic"))
            .withColumn("tactic_no", (F.col("tactic_no") + 1).cast("int")))


def with_risk_tier(scored: DataFrame, prob: str = "churn_probability") -> DataFrame:
    """T8."""
    return scored.withColumn("risk_level", risk_tier(F.col(prob)))


def tier_summary(scored: DataFrame, prob: str = "churn_probability",
                 with_probability: bool = True) -> DataFrame:
    """Per tier (all four, even when empty): customers, Monetary
    mean/sum, mean Frequency, churn rate, mean probability (2 dp).
    Customers without a tier (probability 0) drop out."""
    spark = scored.sparkSession
    tiers = _dim(spark, [(label, i) for i, (_, _, label) in enumerate(RISK_TIERS)],
                 "risk_level string, tier_order int")
    x = with_risk_tier(scored, prob).filter(F.col("risk_level").isNotNull())
    aggs = [F.count(F.lit(1)).alias("customers"),
            round_even(_mean_revenue(), 2).alias("Monetary_mean"),
            round_even(_revenue(), 2).alias("Monetary_sum"),
            round_even(F.avg("Frequency"), 2).alias("Frequency_mean"),
            round_even(F.avg("is_churned"), 2).alias("is_churned_mean")]
    if with_probability:
        aggs.append(round_even(F.avg(prob), 2).alias("churn_probability_mean"))
    g = x.groupBy("risk_level").agg(*aggs)
    out = tiers.join(g, "risk_level", "left")
    return out.withColumn("customers", F.coalesce(F.col("customers"), F.lit(0)).cast("bigint"))


def high_risk_totals(scored: DataFrame, prob: str = "churn_probability",
                     threshold: float = DEFAULT.high_risk_probability) -> DataFrame:
    """Customers with probability ≥ threshold: count, mean F and M,
    revenue at stake."""
    x = scored.filter(F.col(prob) >= threshold)
    return x.agg(F.count(F.lit(1)).alias("customers"),
                 F.avg("Frequency").alias("mean_frequency"),
                 _mean_revenue().alias("mean_monetary"),
                 _revenue().alias("revenue_at_stake"))


def segment_risk(scored: DataFrame, prob: str = "churn_probability") -> DataFrame:
    """Mean / sample std of the probability, size and revenue per
    segment (3 dp), probability descending."""
    g = scored.groupBy("Segment").agg(
        round_even(F.avg(prob), 3).alias("churn_probability_mean"),
        round_even(F.stddev_samp(prob), 3).alias("churn_probability_std"),
        F.count(F.lit(1)).alias("CustomerID_count"),
        round_even(_revenue(), 3).alias("Monetary_sum"))
    return g.orderBy(F.desc("churn_probability_mean"), "Segment")


def segment_risk_ts(scored: DataFrame, prob: str = "churn_probability") -> DataFrame:
    """R10 (time-series step): mean probability (3 dp) and size per
    segment, probability descending."""
    g = scored.groupBy("Segment").agg(round_even(F.avg(prob), 3).alias("churn_probability"),
                                      F.count(F.lit(1)).alias("CustomerID"))
    return g.orderBy(F.desc("churn_probability"), "Segment")


def segment_risk_file(scored: DataFrame, kind: str = "ts",
                      prob: str = "churn_probability") -> DataFrame:
    """The segment risk file of either step (3 dp)."""
    last = ("purchase_interval_trend" if kind == "ts" else "risk_score")
    cols = [F.count(F.lit(1)).alias("CustomerID_count"),
            round_even(F.avg(prob), 3).alias("churn_probability_mean"),
            round_even(F.stddev_samp(prob), 3).alias("churn_probability_std"),
            round_even(F.avg("is_churned"), 3).alias("is_churned_mean"),
            round_even(_mean_revenue(), 3).alias("Monetary_mean"),
            round_even(_revenue(), 3).alias("Monetary_sum")]
    if kind == "ts":
        cols += [round_even(F.avg("recent_activity_ratio_30d"), 3).alias("recent_activity_ratio_30d_mean"),
                 round_even(F.avg(last), 3).alias(f"{last}_mean")]
    else:
        cols += [round_even(F.avg(last), 3).alias(f"{last}_mean"),
                 round_even(F.avg("recent_activity_ratio_30d"), 3).alias("recent_activity_ratio_30d_mean")]
    return scored.groupBy("Segment").agg(*cols)


def early_warning(scored: DataFrame, prob: str = "churn_probability",
                  min_probability: float | None = None) -> DataFrame:
    """Active customers whose purchase gaps widen (trend > 20) and
    whose last-30-day activity is below 20 %; the integrated step also
    requires probability ≥ ``min_probability``."""
    cond = (true_or_false(F.col("purchase_interval_trend") > 20)
            & true_or_false(F.col("recent_activity_ratio_30d") < 0.2)
            & (F.col("is_churned") == 0))
    if min_probability is not None:
        cond = cond & (F.col(prob) >= min_probability)
    return scored.filter(cond).agg(F.count(F.lit(1)).alias("customers"),
                                   F.avg(prob).alias("mean_probability"),
                                   _revenue().alias("revenue_at_risk"))


# -- chart tables ------------------------------------------------------------

def revenue_share_by_segment(rfm: DataFrame, n: int = 10) -> DataFrame:
    """B1."""
    g = rfm.groupBy("Segment").agg(sum_units().alias("_rev"))
    return (g.select("Segment", (money(F.col("_rev")) * 100.0
                                 / money(F.sum("_rev").over(_all()))).alias("revenue_pct"))
            .orderBy(F.desc("revenue_pct"), "Segment").limit(n))


def churn_by_segment(rfm: DataFrame, n: int = 10) -> DataFrame:
    """B2: churn rate with its colour band."""
    g = rfm.groupBy("Segment").agg(_mean("is_churned").alias("churn_rate"))
    band = (F.when(F.col("churn_rate") > 0.5, "red")
            .when(F.col("churn_rate") > 0.3, "orange").otherwise("green"))
    return g.withColumn("band", band).orderBy(F.desc("churn_rate"), "Segment").limit(n)


def high_value_by_segment(rfm: DataFrame, n: int = 10) -> DataFrame:
    """B3."""
    return (rfm.groupBy("Segment").agg(F.sum("is_high_value").cast("bigint").alias("high_value_customers"))
            .orderBy(F.desc("high_value_customers"), "Segment").limit(n))


def probability_histogram(scored: DataFrame, prob: str = "churn_probability",
                          bins: int = 30) -> DataFrame:
    """``bins`` equal-width bins over each class's own min..max (last
    bin closed; a single-valued class lands in the middle bin)."""
    rng = scored.groupBy("is_churned").agg(F.min(prob).alias("_lo"), F.max(prob).alias("_hi"))
    x = scored.select("is_churned", prob).join(F.broadcast(rng), "is_churned")
    width = F.col("_hi") - F.col("_lo")
    b = (F.when(width == 0, F.lit(bins // 2))
         .otherwise(F.least(F.floor((F.col(prob) - F.col("_lo")) * (F.lit(float(bins)) / width)),
                            F.lit(bins - 1))))
    return x.groupBy("is_churned", b.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("customers"))


def tier_shares(scored: DataFrame, prob: str = "churn_probability") -> DataFrame:
    """Customers and % of all customers per tier."""
    x = with_risk_tier(scored, prob)
    g = x.groupBy("risk_level").agg(F.count(F.lit(1)).alias("customers"))
    total = F.sum("customers").over(_all())
    return (g.withColumn("pct", F.col("customers").cast("double") * 100.0 / total.cast("double"))
            .filter(F.col("risk_level").isNotNull()))


def mean_probability_by_segment(scored: DataFrame, prob: str = "churn_probability",
                                n: int = 10) -> DataFrame:
    """Top segments by mean probability, with the overall mean."""
    g = scored.groupBy("Segment").agg(F.avg(prob).alias("mean_probability"),
                                      F.sum(prob).alias("_s"), F.count(F.lit(1)).alias("_n"))
    overall = F.sum("_s").over(_all()) / F.sum("_n").over(_all()).cast("double")
    return (g.withColumn("overall_mean", overall).drop("_s", "_n")
            .orderBy(F.desc("mean_probability"), "Segment").limit(n))


def rf_scatter(rfm: DataFrame) -> DataFrame:
    """The points of the Recency × Frequency chart coloured by Monetary."""
    return rfm.select("CustomerID", "Recency", "Frequency", "Monetary")
