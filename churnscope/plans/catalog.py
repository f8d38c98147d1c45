"""The query catalog: one entry per operator family of the inventory.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with an
independent DuckDB statement over the raw test tables (``None`` for model
training, whose results are checked on rows only). Floating columns that
two engines may sum in a different order are rounded half to even to 6 dp on
both sides (``round_even`` / ``round_sql``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnscope.functions.columns import money, round_even, to_double
from churnscope.functions.rules import ACTION_PLANS, SEGMENT_STRATEGY
from churnscope.operators import campaign as cp
from churnscope.operators import clean as cl
from churnscope.operators import metrics as mt
from churnscope.operators import ml_prep as mp
from churnscope.operators import reports as rp
from churnscope.operators import rfm as rf
from churnscope.operators import sequences as sq
from churnscope.operators.features import TS_MODEL_FEATURES
from churnscope.operators.ranking import materialize
from churnscope.plans import modeling as mdl
from churnscope.plans import oracle as O
from churnscope.plans import steps as st
from churnscope.session import ensure_checkpoint_dir
from churnscope.sources import read_rejects, read_transactions
from churnscope.streaming import current_alerts, replay

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column half to even (same formula as the SQL side)."""
    return df.select(*[round_even(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def sql(body: str, source: str = "orders", level: str = "rfm") -> str:
    churn = st.params_for(source).churn_days
    prefix = {"clean": [O.TX_ORDERS if source == "orders" else O.TX_EVENTS, O.CLEAN],
              "rfm": O.rfm_prefix(source, churn),
              "seq": O.seq_prefix(source, churn),
              "data": O.data_prefix(source, churn)}[level]
    return O.with_ctes(*prefix, body=body)


def R(expr: str, digits: int = 6) -> str:
    return O.round_sql(expr, digits)


# ---------------------------------------------------------------------------
# sources and cleaning
# ---------------------------------------------------------------------------

TX_COLS = ("InvoiceNo, StockCode, Quantity, InvoiceDate, CAST(UnitPrice AS DOUBLE) AS UnitPrice, "
           "CustomerID, Country")


def _tx_double(df: DataFrame) -> DataFrame:
    return df.withColumn("UnitPrice", to_double(F.col("UnitPrice")))


@register("transactions_orders", sql(f"SELECT {TX_COLS} FROM tx", level="clean"))
def q_transactions_orders(spark, sf):
    return _tx_double(st.transactions(spark, sf, "orders", with_country=True))


@register("transactions_events", sql(f"SELECT {TX_COLS} FROM tx", "events", level="clean"))
def q_transactions_events(spark, sf):
    return _tx_double(st.transactions(spark, sf, "events"))


VALID_COLS = TX_COLS + ", CAST(TotalAmount AS DOUBLE) AS TotalAmount"


def _valid_double(df: DataFrame) -> DataFrame:
    return _tx_double(df).withColumn("TotalAmount", to_double(F.col("TotalAmount"))).drop(
        "amount_units")


@register("valid_sales", sql(f"SELECT {VALID_COLS} FROM clean", level="clean"))
def q_valid_sales(spark, sf):
    return _valid_double(cl.valid_sales(st.transactions(spark, sf, "orders", with_country=True)))


@register("valid_sales_country",
          sql(f"SELECT {VALID_COLS} FROM clean WHERE Country = 'NATION_1'", level="clean"))
def q_valid_sales_country(spark, sf):
    return _valid_double(st.clean_lines(spark, sf, "orders", country="NATION_1"))


@register("returns_sample", sql(
    "SELECT InvoiceNo, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID FROM tx "
    "WHERE CustomerID IS NOT NULL AND coalesce(contains(InvoiceNo, 'C'), false) "
    "ORDER BY InvoiceNo, CustomerID, Quantity, UnitPrice LIMIT 5", level="clean"))
def q_returns_sample(spark, sf):
    return cl.returns_sample(st.transactions(spark, sf, "orders"), 5)


PROFILE_SQL = sql("""
SELECT count(*) AS raw_rows,
  count_if(CustomerID IS NULL) AS null_customers,
  count(DISTINCT CustomerID) AS raw_customers,
  count_if(CustomerID IS NOT NULL) AS rows_with_customer,
  count(*) - count_if(CustomerID IS NOT NULL) AS removed_rows,
  min(CASE WHEN CustomerID IS NOT NULL THEN InvoiceDate END) AS first_date,
  max(CASE WHEN CustomerID IS NOT NULL THEN InvoiceDate END) AS last_date,
  date_sub('day', min(CASE WHEN CustomerID IS NOT NULL THEN InvoiceDate END),
                  max(CASE WHEN CustomerID IS NOT NULL THEN InvoiceDate END)) AS span_days,
  count_if(CustomerID IS NOT NULL AND Quantity < 0) AS negative_quantity,
  count_if(CustomerID IS NOT NULL AND UnitPrice <= 0) AS nonpositive_price,
  count_if(CustomerID IS NOT NULL AND coalesce(contains(InvoiceNo, 'C'), false)) AS return_lines,
  count(DISTINCT CASE WHEN CustomerID IS NOT NULL AND coalesce(contains(InvoiceNo, 'C'), false)
                      THEN CustomerID END) AS return_customers,
  count_if(CustomerID IS NOT NULL AND Quantity > 0 AND UnitPrice > 0
           AND NOT coalesce(contains(InvoiceNo, 'C'), false)) AS valid_rows,
  count(DISTINCT CASE WHEN CustomerID IS NOT NULL AND Quantity > 0 AND UnitPrice > 0
           AND NOT coalesce(contains(InvoiceNo, 'C'), false) THEN CustomerID END) AS valid_customers
FROM tx""", level="clean")


@register("profile", PROFILE_SQL)
def q_profile(spark, sf):
    return cl.profile(st.transactions(spark, sf, "orders"))


@register("profile_events", PROFILE_SQL.replace(O.TX_ORDERS.strip("\n"), O.TX_EVENTS.strip("\n")))
def q_profile_events(spark, sf):
    return cl.profile(st.transactions(spark, sf, "events"))


def _describe_sql(cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count({x}) AS count, {R(f'avg({x})')} AS mean, "
            f"{R(f'stddev_samp({x})')} AS std, {R(f'min({x})')} AS min, "
            f"{R(f'quantile_cont({x}, 0.25)')} AS p25, {R(f'quantile_cont({x}, 0.5)')} AS p50, "
            f"{R(f'quantile_cont({x}, 0.75)')} AS p75, {R(f'max({x})')} AS max FROM clean")
    return sql(" UNION ALL ".join(parts), level="clean")


@register("describe_valid", _describe_sql(["Quantity", "UnitPrice", "TotalAmount"]))
def q_describe_valid(spark, sf):
    clean = st.clean_lines(spark, sf)
    return rounded(cl.describe_columns(clean, ["Quantity", "UnitPrice", "TotalAmount"]))


@register("top_countries", sql(
    "SELECT Country, count(*) AS lines FROM clean GROUP BY Country "
    "ORDER BY lines DESC, Country LIMIT 10", level="clean"))
def q_top_countries(spark, sf):
    clean = cl.valid_sales(st.transactions(spark, sf, "orders", with_country=True))
    return cl.top_values(clean, "Country", 10)


@register("country_share", sql(
    "SELECT count_if(Country = 'NATION_1') / CAST(count(*) AS DOUBLE) AS share FROM clean",
    level="clean"))
def q_country_share(spark, sf):
    clean = cl.valid_sales(st.transactions(spark, sf, "orders", with_country=True))
    return cl.value_share(clean, "Country", "NATION_1")


# ---------------------------------------------------------------------------
# RFM (A1-A9, T1-T7, L1-L2)
# ---------------------------------------------------------------------------

@register("analysis_date", sql("SELECT analysis_date FROM ad", level="clean"))
def q_analysis_date(spark, sf):
    return rf.analysis_date(st.clean_lines(spark, sf))


@register("rfm_base", sql(
    "SELECT CustomerID, Recency, Frequency, Monetary, avg_order_value, customer_lifetime_days, "
    "avg_purchase_interval FROM b2"))
def q_rfm_base(spark, sf):
    return rf.rfm_base(st.clean_lines(spark, sf)).select(
        "CustomerID", "Recency", "Frequency", "Monetary", "avg_order_value",
        "customer_lifetime_days", "avg_purchase_interval")


@register("rfm_scores", sql(
    "SELECT CustomerID, rk_r AS recency_rank, R_Score, F_Score, M_Score, "
    "CAST(R_Score AS VARCHAR) || CAST(F_Score AS VARCHAR) || CAST(M_Score AS VARCHAR) AS RFM_Score "
    "FROM scored"))
def q_rfm_scores(spark, sf):
    table = st.rfm_internal(spark, sf)
    return table.select("CustomerID", "R_Score", "F_Score", "M_Score", "RFM_Score").join(rf.recency_rank(table), "CustomerID")


@register("rfm_table", sql(f"SELECT {O.RFM_COLUMNS_SQL} FROM rfm"))
def q_rfm_table(spark, sf):
    return st.rfm_table(spark, sf)


@register("rfm_table_events", sql(f"SELECT {O.RFM_COLUMNS_SQL} FROM rfm", "events"))
def q_rfm_table_events(spark, sf):
    return st.rfm_table(spark, sf, "events")


@register("high_value_threshold", sql(
    f"SELECT {R('quantile_cont(Monetary, 0.8)')} AS threshold FROM b2"))
def q_high_value_threshold(spark, sf):
    return rounded(st.rfm_internal(spark, sf).agg(F.max("_hv_threshold").alias("threshold")))


@register("population_stats", sql(
    f"SELECT {R('avg(avg_order_value)')} AS mean_aov, "
    f"{R('avg(avg_purchase_interval)')} AS mean_purchase_interval, "
    f"{R('sum(Recency) / CAST(count(*) AS DOUBLE)')} AS mean_recency, "
    f"{R('sum(Frequency) / CAST(count(*) AS DOUBLE)')} AS mean_frequency, "
    f"{R('avg(Monetary)')} AS mean_monetary, {R('avg(is_churned)')} AS churn_rate, "
    f"{R('quantile_cont(avg_order_value, 0.5)')} AS median_aov FROM rfm"))
def q_population_stats(spark, sf):
    return rounded(rf.population_stats(st.rfm_table(spark, sf)))


@register("score_distribution", sql("""
SELECT s.score,
  (SELECT count(*) FROM rfm WHERE R_Score = s.score) AS recency_customers,
  (SELECT count(*) FROM rfm WHERE F_Score = s.score) AS frequency_customers,
  (SELECT count(*) FROM rfm WHERE M_Score = s.score) AS monetary_customers
FROM (SELECT DISTINCT R_Score AS score FROM rfm UNION SELECT DISTINCT F_Score FROM rfm
      UNION SELECT DISTINCT M_Score FROM rfm) s"""))
def q_score_distribution(spark, sf):
    return rf.score_distribution(st.rfm_table(spark, sf))


# ---------------------------------------------------------------------------
# segment reports
# ---------------------------------------------------------------------------

@register("segment_sizes", sql(
    f"SELECT Segment, count(*) AS customers, "
    f"{R('count(*) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS pct "
    "FROM rfm GROUP BY Segment"))
def q_segment_sizes(spark, sf):
    return rounded(rp.segment_sizes(st.rfm_table(spark, sf)))


@register("churn_totals", sql(
    "SELECT count(*) AS customers, sum(is_churned) / CAST(count(*) AS DOUBLE) AS churn_rate, "
    "CAST(count(*) - sum(is_churned) AS BIGINT) AS active, CAST(sum(is_churned) AS BIGINT) AS churned, "
    "CASE WHEN sum(is_churned) > 0 THEN CAST(count(*) - sum(is_churned) AS DOUBLE) / "
    "CAST(sum(is_churned) AS DOUBLE) END AS class_ratio FROM rfm"))
def q_churn_totals(spark, sf):
    return rp.churn_totals(st.rfm_table(spark, sf))


@register("segment_churn", sql(
    f"SELECT Segment, {R('sum(is_churned) / CAST(count(*) AS DOUBLE)', 3)} AS Churn_Rate, "
    "count(*) AS Customer_Count FROM rfm GROUP BY Segment"))
def q_segment_churn(spark, sf):
    return rp.segment_churn(st.rfm_table(spark, sf))


@register("high_value_share", sql(
    f"SELECT count_if(is_high_value = 1) AS high_value_customers, "
    f"{R('count_if(is_high_value = 1) * 100.0 / CAST(count(*) AS DOUBLE)')} AS high_value_pct, "
    f"{R('CAST(coalesce(sum(CASE WHEN is_high_value = 1 THEN mon END), 0) AS DOUBLE) * 100.0 / CAST(sum(mon) AS DOUBLE)')} "
    "AS revenue_share_pct FROM rfm"))
def q_high_value_share(spark, sf):
    return rounded(rp.high_value_share(st.rfm_internal(spark, sf)))


SEGMENT_SUMMARY_SQL = sql(f"""
SELECT Segment,
  {R('sum(Recency) / CAST(count(*) AS DOUBLE)', 2)} AS Avg_Recency,
  {R('sum(Frequency) / CAST(count(*) AS DOUBLE)', 2)} AS Avg_Frequency,
  {R('CAST(sum(mon) AS DOUBLE) / CAST(count(*) AS DOUBLE)', 2)} AS Avg_Monetary,
  {R('CAST(sum(mon) AS DOUBLE)', 2)} AS Total_Revenue,
  {R('avg(avg_order_value)', 2)} AS Avg_AOV,
  {R('sum(is_churned) / CAST(count(*) AS DOUBLE)', 2)} AS Churn_Rate,
  CAST(sum(is_high_value) AS BIGINT) AS High_Value_Count,
  count(*) AS Customer_Count,
  {R(R('CAST(sum(mon) AS DOUBLE)', 2) + ' / CAST(sum(sum(mon)) OVER () AS DOUBLE) * 100.0', 1)}
    AS Revenue_Contribution
FROM rfm GROUP BY Segment""")


@register("segment_summary", SEGMENT_SUMMARY_SQL)
def q_segment_summary(spark, sf):
    return rp.segment_summary(st.rfm_internal(spark, sf))


@register("top_revenue_segments", SEGMENT_SUMMARY_SQL.replace(
    "FROM rfm GROUP BY Segment", "FROM rfm GROUP BY Segment) "
    "SELECT Segment, Revenue_Contribution, Customer_Count FROM ss "
    "ORDER BY Revenue_Contribution DESC, Segment LIMIT 3").replace(
    "\nSELECT Segment,\n  ", ", ss AS (SELECT Segment,\n  ", 1))
def q_top_revenue_segments(spark, sf):
    return rp.top_segments_by_revenue(rp.segment_summary(st.rfm_internal(spark, sf)), 3)


@register("at_risk_revenue", sql(
    "SELECT Segment, count(*) AS customers, CAST(sum(mon) AS DOUBLE) AS revenue FROM rfm "
    "WHERE Segment IN ('At Risk', 'Cannot Lose Them') GROUP BY Segment"))
def q_at_risk_revenue(spark, sf):
    return rp.at_risk_revenue(st.rfm_internal(spark, sf))


@register("high_risk_customers", sql(
    f"SELECT {O.RFM_COLUMNS_SQL} FROM rfm WHERE Segment IN ('At Risk', 'Cannot Lose Them') "
    "ORDER BY Monetary DESC, CustomerID"))
def q_high_risk_customers(spark, sf):
    return rp.high_risk_list(st.rfm_internal(spark, sf))


STRATEGY_ROWS = " UNION ALL ".join(
    f"SELECT '{k}' AS Segment, '{v}' AS strategy" for k, v in SEGMENT_STRATEGY.items())


@register("segment_strategy", sql(
    f"SELECT r.Segment, count(*) AS customers, d.strategy FROM rfm r JOIN ({STRATEGY_ROWS}) d "
    "ON r.Segment = d.Segment GROUP BY r.Segment, d.strategy"))
def q_segment_strategy(spark, sf):
    return rp.segment_strategy(st.rfm_table(spark, sf))


@register("revenue_share_by_segment", sql(
    f"SELECT Segment, {R('CAST(sum(mon) AS DOUBLE) * 100.0 / CAST(sum(sum(mon)) OVER () AS DOUBLE)')} "
    "AS revenue_pct FROM rfm GROUP BY Segment ORDER BY revenue_pct DESC, Segment LIMIT 10"))
def q_revenue_share_by_segment(spark, sf):
    return rounded(rp.revenue_share_by_segment(st.rfm_internal(spark, sf)))


@register("churn_by_segment", sql(
    "SELECT Segment, churn_rate, CASE WHEN churn_rate > 0.5 THEN 'red' WHEN churn_rate > 0.3 "
    "THEN 'orange' ELSE 'green' END AS band FROM (SELECT Segment, sum(is_churned) / "
    "CAST(count(*) AS DOUBLE) AS churn_rate FROM rfm GROUP BY Segment) "
    "ORDER BY churn_rate DESC, Segment LIMIT 10"))
def q_churn_by_segment(spark, sf):
    return rp.churn_by_segment(st.rfm_table(spark, sf))


@register("high_value_by_segment", sql(
    "SELECT Segment, CAST(sum(is_high_value) AS BIGINT) AS high_value_customers FROM rfm "
    "GROUP BY Segment ORDER BY high_value_customers DESC, Segment LIMIT 10"))
def q_high_value_by_segment(spark, sf):
    return rp.high_value_by_segment(st.rfm_table(spark, sf))


@register("rf_scatter", sql("SELECT CustomerID, Recency, Frequency, Monetary FROM rfm"))
def q_rf_scatter(spark, sf):
    return rp.rf_scatter(st.rfm_table(spark, sf))


# ---------------------------------------------------------------------------
# sequences
# ---------------------------------------------------------------------------

@register("daily_purchases", sql(
    "SELECT CustomerID, CAST(InvoiceDate AS DATE) AS Date, CAST(sum(TotalAmount) AS DOUBLE) AS Amount, "
    "count(DISTINCT coalesce(InvoiceNo, 'nan')) AS Orders FROM clean "
    "GROUP BY CustomerID, CAST(InvoiceDate AS DATE)", level="clean"))
def q_daily_purchases(spark, sf):
    return sq.daily_purchases(st.clean_lines(spark, sf))


HALF_COLS = [("CustomerID", False), ("frequency_trend", True), ("monetary_trend", True),
             ("interval_trend", True)]


@register("half_trends", sql(O.select_rounded(HALF_COLS, "half_tr"), level="seq"))
def q_half_trends(spark, sf):
    return rounded(sq.half_trends(st.sequence_stats(spark, sf)))


@register("half_trends_events", sql(O.select_rounded(HALF_COLS, "half_tr"), "events", level="seq"))
def q_half_trends_events(spark, sf):
    return rounded(sq.half_trends(st.sequence_stats(spark, sf, "events")))


@register("trend_summary", sql(
    "SELECT count(*) AS customers, count_if(frequency_trend < -0.3) AS frequency_decline, "
    "count_if(monetary_trend < -0.3) AS monetary_decline, count_if(interval_trend > 10) "
    "AS interval_increase FROM half_tr", level="seq"))
def q_trend_summary(spark, sf):
    return sq.trend_summary(sq.half_trends(st.sequence_stats(spark, sf)))


TS_INT = {"total_transactions", "unique_purchase_days", "unique_products"}
TS_COLS = [("CustomerID", False)] + [(c, c not in TS_INT) for c in sq.TS_FEATURES]
CH_COLS = [("CustomerID", False)] + [(c, c not in TS_INT) for c in sq.CH_FEATURES]


@register("ts_features", sql(O.select_rounded(TS_COLS, "ts_feat"), level="seq"))
def q_ts_features(spark, sf):
    return rounded(sq.features_ts(st.sequence_stats(spark, sf)))


@register("ts_features_events", sql(O.select_rounded(TS_COLS, "ts_feat"), "events", level="seq"))
def q_ts_features_events(spark, sf):
    return rounded(sq.features_ts(st.sequence_stats(spark, sf, "events")))


@register("ch_features", sql(O.select_rounded(CH_COLS, "ch_feat"), level="seq"))
def q_ch_features(spark, sf):
    return rounded(sq.features_ch(st.sequence_stats(spark, sf)))


@register("ch_features_events", sql(O.select_rounded(CH_COLS, "ch_feat"), "events", level="seq"))
def q_ch_features_events(spark, sf):
    return rounded(sq.features_ch(st.sequence_stats(spark, sf, "events")))


TS_DERIVED = [("CustomerID", False), ("Segment", False), ("is_churned", False),
              ("RF_Score", False), ("RM_Score", False), ("FM_Score", False),
              ("RFM_Score_Sum", False), ("customer_lifetime_days", False),
              ("lifetime_value_per_day", True), ("purchase_efficiency", True),
              ("interval_risk", False), ("activity_risk", False), ("monetary_risk", False),
              ("risk_score", False), ("Segment_Encoded", False)]
CH_DERIVED = [("CustomerID", False), ("Segment", False), ("is_churned", False),
              ("FM_Score", False), ("F_Score_squared", False), ("M_Score_squared", False),
              ("interval_risk", False), ("activity_risk", False), ("monetary_risk", False),
              ("frequency_risk", False), ("risk_score", False), ("segment_risk_level", False),
              ("customer_value_score", True), ("avg_order_value", True), ("lifetime_days", False),
              ("lifetime_value_per_day", True)]


@register("ts_feature_table", sql(O.select_rounded(TS_DERIVED, "ts_data"), level="data"))
def q_ts_feature_table(spark, sf):
    return rounded(st.feature_table(spark, sf, "ts").select(*[c for c, _ in TS_DERIVED]))


@register("ch_feature_table", sql(O.select_rounded(CH_DERIVED, "ch_data"), level="data"))
def q_ch_feature_table(spark, sf):
    return rounded(st.feature_table(spark, sf, "ch").select(*[c for c, _ in CH_DERIVED]))


@register("ch_feature_table_events", sql(O.select_rounded(CH_DERIVED, "ch_data"), "events",
                                         level="data"))
def q_ch_feature_table_events(spark, sf):
    return rounded(st.feature_table(spark, sf, "ch", "events").select(*[c for c, _ in CH_DERIVED]))


# ---------------------------------------------------------------------------
# tiers and probability reports on the deterministic score (T8, R8-R12,
# L6, B4-B6)
# ---------------------------------------------------------------------------


TIER_SQL = ("CASE WHEN churn_probability > 0.0 AND churn_probability <= 0.3 THEN 'Low' "
            "WHEN churn_probability > 0.3 AND churn_probability <= 0.5 THEN 'Medium' "
            "WHEN churn_probability > 0.5 AND churn_probability <= 0.7 THEN 'High' "
            "WHEN churn_probability > 0.7 AND churn_probability <= 1.0 THEN 'Very High' END")


def _scored(spark, sf, kind="ts", source="orders"):
    return st.score_fixture(spark, sf, source, kind)


@register("risk_tiers", sql(
    f"SELECT CustomerID, churn_probability, {TIER_SQL} AS risk_level FROM ts_data", level="data"))
def q_risk_tiers(spark, sf):
    return rp.with_risk_tier(_scored(spark, sf)).select("CustomerID", "churn_probability",
                                                        "risk_level")


@register("tier_summary", sql(f"""
SELECT t.risk_level, t.tier_order, CAST(coalesce(g.customers, 0) AS BIGINT) AS customers,
       g.Monetary_mean, g.Monetary_sum, g.Frequency_mean, g.is_churned_mean, g.churn_probability_mean
FROM (SELECT * FROM (VALUES ('Low', 0), ('Medium', 1), ('High', 2), ('Very High', 3))
      v(risk_level, tier_order)) t
LEFT JOIN (
  SELECT risk_level, count(*) AS customers,
    {R('CAST(sum(mon) AS DOUBLE) / CAST(count(*) AS DOUBLE)', 2)} AS Monetary_mean, {R('CAST(sum(mon) AS DOUBLE)', 2)} AS Monetary_sum,
    {R('avg(Frequency)', 2)} AS Frequency_mean, {R('avg(is_churned)', 2)} AS is_churned_mean,
    {R('avg(churn_probability)', 2)} AS churn_probability_mean
  FROM (SELECT *, {TIER_SQL} AS risk_level FROM ch_data) WHERE risk_level IS NOT NULL
  GROUP BY risk_level) g ON t.risk_level = g.risk_level""", level="data"))
def q_tier_summary(spark, sf):
    return rp.tier_summary(_scored(spark, sf, "ch"))


@register("high_risk_totals", sql(
    f"SELECT count(*) AS customers, {R('avg(Frequency)')} AS mean_frequency, "
    f"{R('CAST(sum(mon) AS DOUBLE) / CAST(count(*) AS DOUBLE)')} AS mean_monetary, "
    f"{R('CAST(sum(mon) AS DOUBLE)')} AS revenue_at_stake "
    "FROM ts_data WHERE churn_probability >= 0.7", level="data"))
def q_high_risk_totals(spark, sf):
    return rounded(rp.high_risk_totals(_scored(spark, sf)))


@register("segment_risk", sql(
    f"SELECT Segment, {R('avg(churn_probability)', 3)} AS churn_probability_mean, "
    f"{R('stddev_samp(churn_probability)', 3)} AS churn_probability_std, "
    f"count(*) AS CustomerID_count, {R('CAST(sum(mon) AS DOUBLE)', 3)} AS Monetary_sum "
    "FROM ch_data GROUP BY Segment", level="data"))
def q_segment_risk(spark, sf):
    return rp.segment_risk(_scored(spark, sf, "ch"))


def _segment_risk_file_sql(kind: str) -> str:
    src = "ts_data" if kind == "ts" else "ch_data"
    tail = (f"{R('avg(recent_activity_ratio_30d)', 3)} AS recent_activity_ratio_30d_mean, "
            f"{R('avg(purchase_interval_trend)', 3)} AS purchase_interval_trend_mean"
            if kind == "ts" else
            f"{R('avg(risk_score)', 3)} AS risk_score_mean, "
            f"{R('avg(recent_activity_ratio_30d)', 3)} AS recent_activity_ratio_30d_mean")
    return sql(
        f"SELECT Segment, count(*) AS CustomerID_count, "
        f"{R('avg(churn_probability)', 3)} AS churn_probability_mean, "
        f"{R('stddev_samp(churn_probability)', 3)} AS churn_probability_std, "
        f"{R('avg(is_churned)', 3)} AS is_churned_mean, "
        f"{R('CAST(sum(mon) AS DOUBLE) / CAST(count(*) AS DOUBLE)', 3)} AS Monetary_mean, "
        f"{R('CAST(sum(mon) AS DOUBLE)', 3)} AS Monetary_sum, {tail} FROM {src} GROUP BY Segment",
        level="data")


@register("segment_risk_file_ts", _segment_risk_file_sql("ts"))
def q_segment_risk_file_ts(spark, sf):
    return rp.segment_risk_file(_scored(spark, sf), "ts")


@register("segment_risk_file_ch", _segment_risk_file_sql("ch"))
def q_segment_risk_file_ch(spark, sf):
    return rp.segment_risk_file(_scored(spark, sf, "ch"), "ch")


EARLY = ("coalesce(purchase_interval_trend > 20, false) AND coalesce(recent_activity_ratio_30d < 0.2, false) "
         "AND is_churned = 0")


@register("early_warning_ts", sql(
    f"SELECT count(*) AS customers, {R('avg(churn_probability)')} AS mean_probability, "
    f"{R('CAST(sum(mon) AS DOUBLE)')} AS revenue_at_risk FROM ts_data WHERE {EARLY}", level="data"))
def q_early_warning_ts(spark, sf):
    return rounded(rp.early_warning(_scored(spark, sf)))


@register("early_warning_ch", sql(
    f"SELECT count(*) AS customers, {R('avg(churn_probability)')} AS mean_probability, "
    f"{R('CAST(sum(mon) AS DOUBLE)')} AS revenue_at_risk FROM ch_data WHERE {EARLY} "
    "AND churn_probability >= 0.5", level="data"))
def q_early_warning_ch(spark, sf):
    return rounded(rp.early_warning(_scored(spark, sf, "ch"), min_probability=0.5))


@register("early_warning_stream", sql(
    f"SELECT CustomerID, {R('purchase_interval_trend')} AS purchase_interval_trend, "
    f"{R('recent_activity_ratio_30d')} AS recent_activity_ratio_30d FROM ts_data WHERE {EARLY}", level="data"))
def q_early_warning_stream(spark, sf):
    """The customers that warn after the purchases came in four deliveries,
    with a restart of the stream after each."""
    purchases = sq.ts_grain(st.clean_lines(spark, sf)).select("CustomerID", "ts", "n")
    return rounded(current_alerts(replay(spark, purchases)))


ACTION_ROWS = " UNION ALL ".join(
    f"SELECT '{seg}' AS Segment, '{act}' AS action, CAST({i + 1} AS INTEGER) AS tactic_no, "
    f"'{tac}' AS tactic"
    for seg, (act, tacs) in ACTION_PLANS.items() for i, tac in enumerate(tacs))


@register("segment_actions", sql(
    f"SELECT g.Segment, g.customers, {R('g.mean_probability')} AS mean_probability, d.action, "
    f"d.tactic_no, d.tactic FROM (SELECT Segment, count(*) AS customers, "
    f"avg(churn_probability) AS mean_probability FROM ts_data GROUP BY Segment) g "
    f"JOIN ({ACTION_ROWS}) d ON g.Segment = d.Segment", level="data"))
def q_segment_actions(spark, sf):
    return rounded(rp.segment_actions(_scored(spark, sf)))


@register("tier_shares", sql(
    f"SELECT risk_level, customers, {R('customers * 100.0 / CAST(total AS DOUBLE)')} AS pct FROM ("
    f"SELECT risk_level, count(*) AS customers, sum(count(*)) OVER () AS total FROM "
    f"(SELECT {TIER_SQL} AS risk_level FROM ts_data) GROUP BY risk_level) WHERE risk_level IS NOT NULL",
    level="data"))
def q_tier_shares(spark, sf):
    return rounded(rp.tier_shares(_scored(spark, sf)))


@register("probability_histogram", sql(
    "SELECT d.is_churned, CAST(CASE WHEN r.hi - r.lo = 0 THEN 15 ELSE "
    "least(floor((d.churn_probability - r.lo) * (30.0 / (r.hi - r.lo))), 29) END AS INTEGER) AS bin, "
    "count(*) AS customers FROM ts_data d JOIN (SELECT is_churned, min(churn_probability) AS lo, "
    "max(churn_probability) AS hi FROM ts_data GROUP BY is_churned) r ON d.is_churned = r.is_churned "
    "GROUP BY 1, 2", level="data"))
def q_probability_histogram(spark, sf):
    return rp.probability_histogram(_scored(spark, sf))


@register("mean_probability_by_segment", sql(
    f"SELECT Segment, {R('avg(churn_probability)')} AS mean_probability, "
    f"{R('sum(sum(churn_probability)) OVER () / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS overall_mean "
    "FROM ch_data GROUP BY Segment ORDER BY mean_probability DESC, Segment LIMIT 10", level="data"))
def q_mean_probability_by_segment(spark, sf):
    return rounded(rp.mean_probability_by_segment(_scored(spark, sf, "ch")))


# ---------------------------------------------------------------------------
# evaluation (V1-V7) on (is_churned, score)
# ---------------------------------------------------------------------------

CUM = """sc AS (SELECT churn_probability AS score, count_if(is_churned = 1) AS pos,
                   count_if(is_churned = 0) AS neg FROM ts_data GROUP BY churn_probability),
cum AS (SELECT *, sum(pos) OVER (ORDER BY score) AS cpos, sum(neg) OVER (ORDER BY score) AS cneg,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc),
pts AS (SELECT score, P - (cpos - pos) AS tp, N - (cneg - neg) AS fp, P, N FROM cum)"""


def _metric_sql(body: str) -> str:
    return O.with_ctes(*O.data_prefix("orders", 120), CUM, body=body)


@register("score_auc", _metric_sql(
    "SELECT CAST(sum(2 * pos * (cneg - neg) + pos * neg) AS DOUBLE) / "
    "CAST(2 * max(P) * max(N) AS DOUBLE) AS auc FROM cum"))
def q_score_auc(spark, sf):
    return mt.auc(_scored(spark, sf))


@register("roc_points", _metric_sql(
    "SELECT score AS threshold, CAST(fp AS DOUBLE) / CAST(N AS DOUBLE) AS fpr, "
    "CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) AS tpr FROM pts"))
def q_roc_points(spark, sf):
    return mt.roc_points(_scored(spark, sf))


@register("pr_points", _metric_sql(
    "SELECT score AS threshold, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision, "
    "CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) AS recall FROM pts"))
def q_pr_points(spark, sf):
    return mt.pr_points(_scored(spark, sf))


@register("best_f1_threshold", _metric_sql(
    "SELECT threshold, f1, precision, recall FROM (SELECT threshold, precision, recall, "
    "2.0 * (precision * recall) / (precision + recall + 1e-10) AS f1 FROM ("
    "SELECT score AS threshold, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision, "
    "CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) AS recall FROM pts)) ORDER BY f1 DESC, threshold LIMIT 1"))
def q_best_f1_threshold(spark, sf):
    return mt.best_f1_threshold(_scored(spark, sf))


@register("score_metrics", sql(
    "SELECT coalesce(CAST(tp AS DOUBLE) / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision, "
    "coalesce(CAST(tp AS DOUBLE) / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall, "
    "coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0.0) AS f1, "
    "CAST(tp + tn AS DOUBLE) / CAST(tp + tn + fp + fn AS DOUBLE) AS accuracy FROM ("
    "SELECT count_if(churn_probability > 0.5 AND is_churned = 1) AS tp, "
    "count_if(churn_probability > 0.5 AND is_churned = 0) AS fp, "
    "count_if(NOT churn_probability > 0.5 AND is_churned = 1) AS fn, "
    "count_if(NOT churn_probability > 0.5 AND is_churned = 0) AS tn FROM ts_data)", level="data"))
def q_score_metrics(spark, sf):
    return mt.classification_metrics(_scored(spark, sf))


@register("confusion", sql(
    "SELECT c.actual, c.predicted, CAST(coalesce(g.customers, 0) AS BIGINT) AS customers FROM "
    "(SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted)) c LEFT JOIN "
    "(SELECT is_churned AS actual, CAST(churn_probability > 0.5 AS INTEGER) AS predicted, "
    "count(*) AS customers FROM ts_data GROUP BY 1, 2) g "
    "ON c.actual = g.actual AND c.predicted = g.predicted", level="data"))
def q_confusion(spark, sf):
    return mt.confusion(_scored(spark, sf))


CORR_FEATURES = ["purchase_interval_trend", "frequency_trend", "amount_trend_ratio",
                 "recent_activity_ratio_30d"]


@register("trend_correlations", sql(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, {R(f'corr(CAST({f} AS DOUBLE), churn_probability)')} AS correlation "
    "FROM ts_data" for f in CORR_FEATURES), level="data"))
def q_trend_correlations(spark, sf):
    return rounded(mt.correlations(_scored(spark, sf), CORR_FEATURES))


# ---------------------------------------------------------------------------
# campaign economics
# ---------------------------------------------------------------------------

def _econ_sql(src: str, thresholds: list[float], value: str, select: str) -> str:
    vals = ", ".join(f"(CAST({t!r} AS DOUBLE))" for t in thresholds)
    return sql(f"""
, v AS (SELECT {value} AS value FROM {src}),
th AS (SELECT * FROM (VALUES {vals}) t(threshold)),
n AS (SELECT th.threshold, (SELECT count(*) FROM {src} d WHERE d.churn_probability >= th.threshold
                             AND d.is_churned = 0) AS targets FROM th),
e AS (SELECT threshold, targets, targets * 5.0 AS cost, targets * 0.25 AS reactivations,
             targets * 0.25 * value AS revenue,
             targets * 0.25 * value - targets * 5.0 AS profit,
             CASE WHEN targets * 5.0 > 0 THEN (targets * 0.25 * value - targets * 5.0)
                  / (targets * 5.0) * 100.0 ELSE 0.0 END AS roi
      FROM n, v)
{select}""", level="data").replace("\n\n, v AS", ", v AS").replace(")\n, v AS", "), v AS")


ECON_COLS = ("threshold, targets, " + R("cost") + " AS cost, " + R("reactivations")
             + " AS reactivations, " + R("revenue") + " AS revenue, " + R("profit")
             + " AS profit, " + R("roi") + " AS roi")


@register("campaign_roi_ts", _econ_sql("ts_data", [0.5, 0.6, 0.7], "avg(avg_order_value)",
                                       f"SELECT {ECON_COLS} FROM e"))
def q_campaign_roi_ts(spark, sf):
    return rounded(cp.campaign_roi(_scored(spark, sf), [0.5, 0.6, 0.7], value_scope="all"))


@register("campaign_roi_ch", _econ_sql(
    "ch_data", [0.5, 0.6, 0.7, 0.8],
    "avg(CASE WHEN is_churned = 0 THEN avg_order_value END)", f"SELECT {ECON_COLS} FROM e"))
def q_campaign_roi_ch(spark, sf):
    return rounded(cp.campaign_roi(_scored(spark, sf, "ch"), [0.5, 0.6, 0.7, 0.8],
                                   value_scope="active"))


#: The sweep written out (numpy.arange(0.40, 0.90, 0.05)), independent of the operator.
SWEEP_GRID = [0.4, 0.45, 0.5, 0.55, 0.6, 0.6499999999999999, 0.7, 0.75, 0.7999999999999999, 0.8499999999999999]


@register("roi_curve", _econ_sql(
    "ch_data", SWEEP_GRID, "avg(CASE WHEN is_churned = 0 THEN avg_order_value END)",
    f"SELECT threshold, targets, {R('roi')} AS roi FROM e"))
def q_roi_curve(spark, sf):
    # the threshold grid stays exact (e.g. 0.6499999999999999); only ROI is rounded
    return cp.roi_curve(_scored(spark, sf, "ch")).withColumn("roi", round_even(F.col("roi"), 6))


@register("roi_best_threshold", _econ_sql(
    "ch_data", SWEEP_GRID, "avg(CASE WHEN is_churned = 0 THEN avg_order_value END)",
    "SELECT coalesce(b.threshold, 0.5) AS threshold, " + R("b.roi") + " AS roi, b.targets "
    "FROM (SELECT 1 AS one) d LEFT JOIN (SELECT threshold, roi, targets FROM e WHERE targets > 10 "
    "ORDER BY floor(roi * 1000000.0 + 0.5) DESC, threshold LIMIT 1) b ON true"))
def q_roi_best_threshold(spark, sf):
    return cp.best_threshold(_scored(spark, sf, "ch")).withColumn("roi", round_even(F.col("roi"), 6))


# ---------------------------------------------------------------------------
# split, scaling, weights (M1-M5)
# ---------------------------------------------------------------------------

SPLIT_SQL = """
, rk AS (SELECT CustomerID, is_churned,
            row_number() OVER (PARTITION BY is_churned ORDER BY md5('42-' || CAST(CustomerID AS VARCHAR)), CustomerID) AS r,
            count(*) OVER (PARTITION BY is_churned) AS nc FROM ts_data),
cuts AS (SELECT *, CAST(ceil(0.3 * CAST(nc AS DOUBLE)) AS BIGINT) AS held FROM rk),
splt AS (SELECT CustomerID, is_churned,
         CASE WHEN r <= nc - held THEN 'train'
              WHEN r <= nc - held + (held - CAST(ceil(0.5 * CAST(held AS DOUBLE)) AS BIGINT)) THEN 'val'
              ELSE 'test' END AS split FROM cuts)"""


def _split_sql(select: str) -> str:
    return O.with_ctes(*O.data_prefix("orders", 120), body="").rstrip("\n") + SPLIT_SQL + "\n" + select


def _split(spark, sf):
    return mp.stratified_split(st.feature_table(spark, sf, "ts"))


@register("stratified_split", _split_sql("SELECT CustomerID, is_churned, split FROM splt"))
def q_stratified_split(spark, sf):
    return _split(spark, sf).select("CustomerID", "is_churned", "split")


@register("split_summary", _split_sql(
    "SELECT split, count(*) AS customers, sum(is_churned) / CAST(count(*) AS DOUBLE) AS churn_rate "
    "FROM splt GROUP BY split"))
def q_split_summary(spark, sf):
    return mp.split_summary(_split(spark, sf))


def _scaler_sql() -> str:
    parts = []
    for f in TS_MODEL_FEATURES:
        x = f"CASE WHEN {f} IS NULL OR isnan(CAST({f} AS DOUBLE)) OR isinf(CAST({f} AS DOUBLE)) THEN 0.0 ELSE CAST({f} AS DOUBLE) END"
        parts.append(f"SELECT '{f}' AS feature, {R(f'avg({x})')} AS mean, {R(f'stddev_pop({x})')} AS std "
                     "FROM ts_data JOIN splt USING (CustomerID) WHERE splt.split = 'train'")
    return _split_sql(" UNION ALL ".join(parts))


@register("scaler_stats", _scaler_sql())
def q_scaler_stats(spark, sf):
    from churnscope.operators.features import model_frame
    split = _split(spark, sf).select("CustomerID", "split")
    frame = model_frame(st.feature_table(spark, sf, "ts"), "ts").join(split, "CustomerID")
    train = frame.filter(F.col("split") == "train")
    return rounded(mp.scaler_stats(train, TS_MODEL_FEATURES))


@register("class_weights", _split_sql(
    "SELECT label, n_class, CAST(total AS DOUBLE) / (2.0 * CAST(n_class AS DOUBLE)) AS balanced_weight, "
    "CAST(neg AS DOUBLE) / CAST(greatest(pos, 1) AS DOUBLE) AS pos_weight FROM ("
    "SELECT is_churned AS label, count(*) AS n_class, sum(count(*)) OVER () AS total, "
    "sum(CASE WHEN is_churned = 0 THEN count(*) ELSE 0 END) OVER () AS neg, "
    "sum(CASE WHEN is_churned = 1 THEN count(*) ELSE 0 END) OVER () AS pos "
    "FROM splt WHERE split = 'train' GROUP BY is_churned)"))
def q_class_weights(spark, sf):
    train = _split(spark, sf).filter(F.col("split") == "train")
    return mp.class_weights(train)


# ---------------------------------------------------------------------------
# models (E1-E11, M6, S10): rows-only checks
# ---------------------------------------------------------------------------



@register("model_comparison_ts")
def q_model_comparison_ts(spark, sf):
    return mdl.ts_step(spark, sf).results


@register("churn_predictions_ts")
def q_churn_predictions_ts(spark, sf):
    return mdl.predictions_export(mdl.ts_step(spark, sf))


@register("feature_importance_ts")
def q_feature_importance_ts(spark, sf):
    return mdl.ts_step(spark, sf).importance


@register("model_comparison_ch")
def q_model_comparison_ch(spark, sf):
    return mdl.ch_step(spark, sf).results


@register("model_performance_final")
def q_model_performance_final(spark, sf):
    return mdl.ch_step(spark, sf).summary


@register("churn_predictions_ch")
def q_churn_predictions_ch(spark, sf):
    return mdl.predictions_export(mdl.ch_step(spark, sf))


@register("feature_importance_ch")
def q_feature_importance_ch(spark, sf):
    return mdl.ch_step(spark, sf).importance


# the gradient of the objective at the optimum is zero in every coordinate
@register("logistic_gradient_ts", sql(
    "SELECT f.feature, count(*) AS customers, CAST(0 AS DOUBLE) AS gradient FROM ts_data, (SELECT unnest(["
    + ", ".join(f"'{f}'" for f in [*TS_MODEL_FEATURES, "(intercept)"]) + "]) AS feature) f GROUP BY f.feature", level="data"))
def q_logistic_gradient_ts(spark, sf):
    """Gradient of the penalised loss over all customers, added up by
    built-in functions from the fitted coefficients, in absolute value to 6 places."""
    from churnscope.operators import logistic
    from churnscope.operators.features import model_frame
    feats = TS_MODEL_FEATURES
    frame = model_frame(st.feature_table(spark, sf, "ts"), "ts")
    scaled = mp.standardize(frame, mp.scaler_stats(frame, feats), feats).select("CustomerID", "is_churned", *feats)
    data = materialize(mp.with_weights(scaled, "is_churned", "balanced", "weight"), "all-rows")
    best = logistic.fit(data, feats, "is_churned", "weight", c=1.0, penalise_intercept=True)
    z = sum((F.col(f) * F.lit(b) for f, b in zip(feats, best.coefficients)), F.lit(best.intercept))
    off = F.col("weight") * (F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) - F.col("is_churned"))
    rows = [(f, x, b) for f, x, b in zip([*feats, "(intercept)"], [*map(F.col, feats), F.lit(1.0)], [*best.coefficients, best.intercept])]
    one = data.agg(F.count(F.lit(1)).alias("customers"), *[(F.sum(off * x) + F.lit(b)).alias(f"g{i}") for i, (_, x, b) in enumerate(rows)])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"g{i}").alias("g")) for i, (f, _, _) in enumerate(rows)])).alias("r")
    return one.select("customers", each).select("r.feature", "customers", round_even(F.abs("r.g"), 6).alias("gradient"))


@register("smote_train")
def q_smote_train(spark, sf):
    """M6 on the events fixture, whose churned class is the minority."""
    from churnscope.operators.features import feature_names, model_frame
    feats = feature_names("ch")
    frame = mp.stratified_split(model_frame(st.feature_table(spark, sf, "ch", "events"), "ch"))
    train = frame.filter(F.col("split") == "train")
    return mp.smote_oversample(mp.standardize(train, mp.scaler_stats(train, feats), feats), feats)


#: Integer features, so that SQL has the same distances.
_NEAR = ["Recency", "Frequency", "customer_lifetime_days"]


@register("smote_neighbours", sql("""
SELECT CustomerID, CAST(row_number() OVER w AS INTEGER) AS j, neighbour, CAST(d AS DOUBLE) AS squared_distance FROM (
  SELECT a.CustomerID, b.CustomerID AS neighbour, (a.Recency - b.Recency) * (a.Recency - b.Recency)
         + (a.Frequency - b.Frequency) * (a.Frequency - b.Frequency)
         + (a.customer_lifetime_days - b.customer_lifetime_days) * (a.customer_lifetime_days - b.customer_lifetime_days) AS d
  FROM rfm a JOIN rfm b ON a.is_churned = b.is_churned AND a.CustomerID <> b.CustomerID
  WHERE a.is_churned = (SELECT is_churned FROM rfm GROUP BY is_churned ORDER BY count(*), is_churned LIMIT 1))
WINDOW w AS (PARTITION BY CustomerID ORDER BY d, neighbour) QUALIFY j <= 5"""))
def q_smote_neighbours(spark, sf):
    """M6: the five nearest customers of the minority class of each of its customers."""
    from churnscope.operators.neighbours import nearest
    table = st.rfm_table(spark, sf)
    least = table.groupBy("is_churned").count().orderBy("count", "is_churned").first()[0]
    rows = table.where(F.col("is_churned") == least).select(
        F.col("CustomerID").cast("long").alias("a"), F.array(*[F.col(c).cast("double") for c in _NEAR]).alias("v"))
    return nearest(rows, 5).select(F.col("a").alias("CustomerID"), "j", F.col("b").alias("neighbour"), F.col("d").alias("squared_distance"))


@register("high_risk_predictions_ts")
def q_high_risk_predictions_ts(spark, sf):
    return mdl.high_risk_export(mdl.ts_step(spark, sf), "ts")


@register("high_risk_predictions_ch")
def q_high_risk_predictions_ch(spark, sf):
    return mdl.high_risk_export(mdl.ch_step(spark, sf), "ch")


# ---------------------------------------------------------------------------
# more oracle-checked operators: describe of R/F/M (Q7), trend sample
# ---------------------------------------------------------------------------

def _describe_rfm_sql() -> str:
    parts = []
    for c in ["Recency", "Frequency", "Monetary"]:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count({x}) AS count, {R(f'avg({x})')} AS mean, "
            f"{R(f'stddev_samp({x})')} AS std, {R(f'min({x})')} AS min, "
            f"{R(f'quantile_cont({x}, 0.25)')} AS p25, {R(f'quantile_cont({x}, 0.5)')} AS p50, "
            f"{R(f'quantile_cont({x}, 0.75)')} AS p75, {R(f'max({x})')} AS max FROM rfm")
    return sql(" UNION ALL ".join(parts))


@register("describe_rfm", _describe_rfm_sql())
def q_describe_rfm(spark, sf):
    return rounded(cl.describe_columns(st.rfm_table(spark, sf), ["Recency", "Frequency", "Monetary"]))


@register("trend_sample", sql(
    "SELECT CustomerID FROM rfm WHERE Frequency >= 2 "
    "ORDER BY md5('42|' || CAST(CustomerID AS VARCHAR)), CustomerID LIMIT 1000"))
def q_trend_sample(spark, sf):
    return sq.sample_customers(st.rfm_table(spark, sf), 1000)


# ---------------------------------------------------------------------------
# evaluation of the chosen models on their test split (V2-V6 as in the
# original figures): rows-only, the scores come from Spark ML training
# ---------------------------------------------------------------------------

@register("model_roc_points_ts")
def q_model_roc_points_ts(spark, sf):
    return mt.roc_points(mdl.ts_step(spark, sf).test_scores)


@register("model_pr_points_ts")
def q_model_pr_points_ts(spark, sf):
    return mt.pr_points(mdl.ts_step(spark, sf).test_scores)


@register("model_best_f1_ts")
def q_model_best_f1_ts(spark, sf):
    return mt.best_f1_threshold(mdl.ts_step(spark, sf).test_scores)


@register("model_confusion_ts")
def q_model_confusion_ts(spark, sf):
    return mt.confusion(mdl.ts_step(spark, sf).test_scores, pred="predicted")


@register("model_test_metrics_ch")
def q_model_test_metrics_ch(spark, sf):
    s = mdl.ch_step(spark, sf).test_scores
    return mt.auc(s).crossJoin(mt.classification_metrics(s, pred="predicted"))


# ---------------------------------------------------------------------------
# fixture B (real times of day, churn horizon 5 days) through the reports
# ---------------------------------------------------------------------------

@register("segment_summary_events", O.with_ctes(
    *O.rfm_prefix("events", st.params_for("events").churn_days),
    body="\nSELECT Segment," + SEGMENT_SUMMARY_SQL.rsplit("\nSELECT Segment,", 1)[1]))
def q_segment_summary_events(spark, sf):
    return rp.segment_summary(st.rfm_internal(spark, sf, "events"))


@register("ts_feature_table_events", sql(O.select_rounded(TS_DERIVED, "ts_data"), "events",
                                         level="data"))
def q_ts_feature_table_events(spark, sf):
    return rounded(st.feature_table(spark, sf, "ts", "events").select(*[c for c, _ in TS_DERIVED]))


# ---------------------------------------------------------------------------
# time-series-step variants of the tier summary (R8) and segment risk
# ---------------------------------------------------------------------------

@register("tier_summary_ts", sql(f"""
SELECT t.risk_level, t.tier_order, CAST(coalesce(g.customers, 0) AS BIGINT) AS customers,
       g.Monetary_mean, g.Monetary_sum, g.Frequency_mean, g.is_churned_mean
FROM (SELECT * FROM (VALUES ('Low', 0), ('Medium', 1), ('High', 2), ('Very High', 3))
      v(risk_level, tier_order)) t
LEFT JOIN (
  SELECT risk_level, count(*) AS customers,
    {R('CAST(sum(mon) AS DOUBLE) / CAST(count(*) AS DOUBLE)', 2)} AS Monetary_mean,
    {R('CAST(sum(mon) AS DOUBLE)', 2)} AS Monetary_sum,
    {R('avg(Frequency)', 2)} AS Frequency_mean, {R('avg(is_churned)', 2)} AS is_churned_mean
  FROM (SELECT *, {TIER_SQL} AS risk_level FROM ts_data) WHERE risk_level IS NOT NULL
  GROUP BY risk_level) g ON t.risk_level = g.risk_level""", level="data"))
def q_tier_summary_ts(spark, sf):
    return rp.tier_summary(_scored(spark, sf), with_probability=False)


@register("segment_risk_ts", sql(
    f"SELECT Segment, {R('avg(churn_probability)', 3)} AS churn_probability, "
    "count(*) AS CustomerID FROM ts_data GROUP BY Segment", level="data"))
def q_segment_risk_ts(spark, sf):
    return rp.segment_risk_ts(_scored(spark, sf))


# ---------------------------------------------------------------------------
# readers (S1, S2, S4): the lines as a CSV file in the shared folder, with
# quoted text, sub-cent prices and one unreadable line, read back
# ---------------------------------------------------------------------------

def _csv_file(spark, sf) -> str:
    tx = st.transactions(spark, sf, "orders", with_country=True)
    text = tx.select(
        "StockCode", F.concat(F.lit('CHARLIE+LOLA "EXTREMELY, BUSY" '), F.col("StockCode")).alias("Description"), "InvoiceNo",
        F.col("Quantity").cast("string").alias("Quantity"), F.date_format("InvoiceDate", "M/d/yyyy H:mm").alias("InvoiceDate"),
        (F.col("UnitPrice") + F.lit(0.001).cast("decimal(4,3)")).cast("decimal(20,6)").cast("string").alias("UnitPrice"),
        F.concat(F.col("CustomerID").cast("string"), F.lit(".0")).alias("CustomerID"), "Country")
    bad = spark.createDataFrame([("X", 'a "quote"', "1", "six", "1/1/2011 0:00", "1", "1.0", "Y")], text.columns)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-lines-{uuid.uuid4().hex}"
    text.unionByName(bad).write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


@register("csv_lines", sql("SELECT InvoiceNo, StockCode, Quantity, InvoiceDate, CAST(UnitPrice + 0.001 AS DOUBLE) AS UnitPrice, "
                           "CustomerID, Country FROM tx", level="clean"))
def q_csv_lines(spark, sf):
    return _tx_double(read_transactions(spark, _csv_file(spark, sf), on_reject="skip"))


@register("csv_valid_amounts", sql(
    "SELECT CustomerID, CAST(sum(CAST(Quantity AS DECIMAL(10,0)) * CAST(UnitPrice + 0.001 AS DECIMAL(20,6))) AS DOUBLE) AS Monetary "
    "FROM clean GROUP BY CustomerID", level="clean"))
def q_csv_valid_amounts(spark, sf):
    valid = cl.valid_sales(read_transactions(spark, _csv_file(spark, sf), on_reject="skip"))
    return valid.groupBy("CustomerID").agg(money(F.sum("amount_units")).alias("Monetary"))


@register("csv_rejects", "SELECT 'Quantity' AS reject, CAST(1 AS BIGINT) AS n_lines")
def q_csv_rejects(spark, sf):
    return read_rejects(spark, _csv_file(spark, sf)).groupBy("reject").agg(F.count("*").alias("n_lines"))


# ---------------------------------------------------------------------------
# the model half (E1-E11, S10, S15): what is exact about it, computed from the
# models' outputs; the probabilities themselves have no SQL
# ---------------------------------------------------------------------------

_CHECKED = ("SELECT CustomerID, Segment, Recency, Frequency, is_churned, true AS in_range, true AS tier_matches FROM {0}_data")


def _checked(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        "CustomerID", "Segment", "Recency", "Frequency", F.col("is_churned").cast("int").alias("is_churned"),
        F.col("churn_probability").between(0.0, 1.0).alias("in_range"),
        F.col("risk_level").eqNullSafe(F.expr(TIER_SQL)).alias("tier_matches"))


@register("churn_predictions_ts_checked", sql(_CHECKED.format("ts"), level="data"))
def q_churn_predictions_ts_checked(spark, sf):
    return _checked(mdl.ts_step(spark, sf).predictions)


@register("churn_predictions_ch_checked", sql(_CHECKED.format("ch"), level="data"))
def q_churn_predictions_ch_checked(spark, sf):
    return _checked(mdl.ch_step(spark, sf).predictions)


@register("model_splits_ts", _split_sql(
    "SELECT m.model, split, count(*) AS customers, sum(is_churned) AS churned FROM splt, "
    "(VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient Boosting')) m(model) GROUP BY m.model, split"))
def q_model_splits_ts(spark, sf):
    """The customers behind each metric of each model."""
    out = None
    for name, scores in mdl.ts_step(spark, sf).scores.items():
        part = scores.groupBy("split").agg(F.count("*").alias("customers"), F.sum("is_churned").cast("decimal(38,0)").alias("churned"))
        part = part.select(F.lit(name).alias("model"), "split", "customers", "churned")
        out = part if out is None else out.unionByName(part)
    return out


@register("auc_matches_evaluator_ts", "SELECT * FROM (VALUES ('Logistic Regression', true), ('Random Forest', true), "
                                      "('Gradient Boosting', true)) v(model, same)")
def q_auc_matches_evaluator_ts(spark, sf):
    """Our AUC on the test split against Spark ML's evaluator."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    judge = BinaryClassificationEvaluator(rawPredictionCol="churn_probability", labelCol="label", numBins=0)
    rows = []
    for name, scores in mdl.ts_step(spark, sf).scores.items():
        test = scores.where("split = 'test'").withColumn("label", F.col("is_churned").cast("double"))
        rows.append((name, bool(abs(judge.evaluate(test) - mt.auc(test).first()[0]) < 1e-9)))
    return spark.createDataFrame(rows, "model string, same boolean")


@register("soft_vote_is_mean_ch", sql("SELECT CustomerID, true AS is_mean FROM ch_data", level="data"))
def q_soft_vote_is_mean_ch(spark, sf):
    """The ensemble's probability is the mean over its three voting members."""
    scores = mdl.ch_step(spark, sf).scores
    out = scores["Ensemble"].select("CustomerID", F.col("churn_probability").alias("vote"))
    members = [n for n in scores if n.startswith("vote:")]
    for i, n in enumerate(members):
        out = out.join(scores[n].select("CustomerID", F.col("churn_probability").alias(f"p{i}")), "CustomerID")
    mean = sum(F.col(f"p{i}") for i in range(len(members))) / F.lit(3.0)
    return out.select("CustomerID", (F.abs(F.col("vote") - mean) < 1e-12).alias("is_mean"))


@register("saved_model_rescored_ch", sql("SELECT CustomerID, true AS same FROM ch_data", level="data"))
def q_saved_model_rescored_ch(spark, sf):
    """The scoring model saved, loaded again and applied to all customers."""
    res = mdl.ch_step(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/saved-model-{uuid.uuid4().hex}"
    mdl.save_step(res, path)
    again = mdl.score_saved(spark, path, res.frame).withColumnRenamed("churn_probability", "again")
    return res.predictions.join(again, "CustomerID").select(
        "CustomerID", (F.abs(F.col("churn_probability") - F.col("again")) < 1e-12).alias("same"))


@register("smote_between_parents", "SELECT true AS on_segment, true AS of_minority, true AS has_parents")
def q_smote_between_parents(spark, sf):
    """M6: every synthetic row stands on the segment between its two parents,
    both customers of the minority class; one row of what holds for all."""
    from churnscope.operators.features import feature_names, model_frame
    feats = feature_names("ch")
    frame = mp.stratified_split(model_frame(st.feature_table(spark, sf, "ch", "events"), "ch")).where("split = 'train'")
    train = materialize(mp.standardize(frame, mp.scaler_stats(frame, feats), feats), "smote-train")
    rows = materialize(mp.smote_oversample(train, feats), "smote")
    vec = F.array(*[F.col(f).cast("double") for f in feats])
    a = train.select(F.col("CustomerID").alias("parent"), F.col("is_churned").alias("ya"), vec.alias("va"))
    b = train.select(F.col("CustomerID").alias("neighbour"), F.col("is_churned").alias("yb"), vec.alias("vb"))
    j = (rows.where("synthetic").select("parent", "neighbour", "gap", "is_churned", vec.alias("v"))
         .join(a, "parent", "left").join(b, "neighbour", "left"))
    near = F.forall(F.zip_with(F.col("v"), F.zip_with("va", "vb", lambda x, y: x + (y - x) * F.col("gap")), lambda x, y: F.abs(x - y) < 1e-9), lambda c: c)
    return j.agg(F.coalesce(F.bool_and(near), F.lit(True)).alias("on_segment"),
                 F.coalesce(F.bool_and((F.col("ya") == F.col("is_churned")) & (F.col("yb") == F.col("is_churned"))), F.lit(True)).alias("of_minority"),
                 F.coalesce(F.bool_and(F.col("ya").isNotNull() & F.col("yb").isNotNull()), F.lit(True)).alias("has_parents"))
