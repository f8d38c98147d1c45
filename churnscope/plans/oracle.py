"""Reference SQL (DuckDB dialect) for the catalog queries.

Each statement recomputes its answer from the raw test tables with plain
window functions and aggregates, independently of the Spark operators, so
the two can be compared row for row. Column names match the Spark output.
"""

from __future__ import annotations

# -- sources ----------------------------------------------------------------

TX_ORDERS = """
tx AS (
  SELECT CASE WHEN l.l_returnflag = 'R' THEN 'C' || CAST(o.o_orderkey AS VARCHAR)
              ELSE CAST(o.o_orderkey AS VARCHAR) END AS InvoiceNo,
         CAST(l.l_partkey AS VARCHAR) AS StockCode,
         CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_quantity AS INTEGER)
              ELSE CAST(l.l_quantity AS INTEGER) END AS Quantity,
         o.o_orderdate AS InvoiceDate,
         CAST(p.p_retailprice AS DECIMAL(20,6)) AS UnitPrice,
         o.o_custkey AS CustomerID,
         n.n_name AS Country
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

TX_EVENTS = """
tx AS (
  SELECT CASE WHEN event_type = 'error' THEN 'C' || CAST(event_id AS VARCHAR)
              ELSE CAST(event_id AS VARCHAR) END AS InvoiceNo,
         props AS StockCode,
         CAST(1 AS INTEGER) AS Quantity,
         ts AS InvoiceDate,
         CAST(value AS DECIMAL(20,6)) AS UnitPrice,
         user_id AS CustomerID,
         'ONLINE' AS Country
  FROM events WHERE event_type IN ('purchase', 'error')
)"""

CLEAN = """
clean AS (
  SELECT *, CAST(Quantity AS DECIMAL(10,0)) * UnitPrice AS TotalAmount
  FROM tx
  WHERE Quantity > 0 AND UnitPrice > 0
    AND NOT coalesce(contains(InvoiceNo, 'C'), false)
    AND CustomerID IS NOT NULL
),
ad AS (SELECT max(InvoiceDate) + INTERVAL 1 DAY AS analysis_date FROM clean)"""

RFM = """
base AS (
  SELECT CustomerID, max(InvoiceDate) AS last_ts, min(InvoiceDate) AS first_ts,
         count(DISTINCT InvoiceNo) AS Frequency, sum(TotalAmount) AS mon
  FROM clean GROUP BY CustomerID
),
b2 AS (
  SELECT CustomerID,
         date_sub('day', last_ts, analysis_date) AS Recency,
         Frequency, CAST(mon AS DOUBLE) AS Monetary, mon,
         CAST(mon AS DOUBLE) / CAST(Frequency AS DOUBLE) AS avg_order_value,
         date_sub('day', first_ts, last_ts) AS customer_lifetime_days,
         CASE WHEN Frequency > 1
              THEN CAST(date_sub('day', first_ts, last_ts) AS DOUBLE) / CAST(Frequency - 1 AS DOUBLE)
         END AS avg_purchase_interval,
         first_ts, last_ts, analysis_date
  FROM base, ad
),
ranked AS (
  SELECT *,
         row_number() OVER (ORDER BY Recency, CustomerID) AS rk_r,
         row_number() OVER (ORDER BY Frequency, CustomerID) AS rk_f,
         row_number() OVER (ORDER BY mon, CustomerID) AS rk_m,
         count(*) OVER () AS n
  FROM b2
),
scored AS (
  SELECT *,
    CAST(6 - CASE WHEN n <= 1 THEN 1 ELSE greatest(1, (5 * (rk_r - 1) + n - 2) // (n - 1)) END AS INTEGER) AS R_Score,
    CAST(CASE WHEN n <= 1 THEN 1 ELSE greatest(1, (5 * (rk_f - 1) + n - 2) // (n - 1)) END AS INTEGER) AS F_Score,
    CAST(CASE WHEN n <= 1 THEN 1 ELSE greatest(1, (5 * (rk_m - 1) + n - 2) // (n - 1)) END AS INTEGER) AS M_Score
  FROM ranked
),
rfm AS (
  SELECT CustomerID, Recency, Frequency, Monetary, R_Score, F_Score, M_Score,
    CAST(R_Score AS VARCHAR) || CAST(F_Score AS VARCHAR) || CAST(M_Score AS VARCHAR) AS RFM_Score,
    CASE
      WHEN R_Score >= 4 AND F_Score >= 4 AND M_Score >= 4 THEN 'Champions'
      WHEN R_Score >= 3 AND F_Score >= 3 AND M_Score >= 3 THEN 'Loyal Customers'
      WHEN R_Score >= 3 AND F_Score >= 2 AND M_Score >= 2 THEN 'Potential Loyalists'
      WHEN R_Score >= 4 AND F_Score = 1 THEN 'New Customers'
      WHEN R_Score >= 3 AND F_Score = 1 AND M_Score >= 3 THEN 'Promising'
      WHEN R_Score = 3 AND F_Score >= 2 AND M_Score >= 2 THEN 'Need Attention'
      WHEN R_Score = 2 AND F_Score >= 2 THEN 'About to Sleep'
      WHEN R_Score <= 2 AND F_Score >= 3 AND M_Score >= 3 THEN 'At Risk'
      WHEN R_Score <= 2 AND F_Score >= 4 AND M_Score >= 4 THEN 'Cannot Lose Them'
      WHEN R_Score <= 2 AND F_Score <= 2 AND M_Score <= 2 THEN 'Hibernating'
      WHEN R_Score = 1 THEN 'Lost'
      ELSE 'Others' END AS Segment,
    CAST(Recency > {churn_days} AS INTEGER) AS is_churned,
    CAST(Monetary >= (SELECT quantile_cont(Monetary, 0.8) FROM b2) AS INTEGER) AS is_high_value,
    avg_order_value, customer_lifetime_days, avg_purchase_interval,
    first_ts, last_ts, analysis_date, mon
  FROM scored
)"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n" + body


def rfm_prefix(source: str = "orders", churn_days: int = 120) -> list[str]:
    tx = TX_ORDERS if source == "orders" else TX_EVENTS
    return [tx, CLEAN, RFM.replace("{churn_days}", str(churn_days))]


RFM_COLUMNS_SQL = ("CustomerID, Recency, Frequency, Monetary, R_Score, F_Score, M_Score, "
                   "RFM_Score, Segment, is_churned, is_high_value, avg_order_value, "
                   "customer_lifetime_days, avg_purchase_interval")

# -- sequence features -------------------------------------------------------

SEQ = """
lines AS (SELECT CustomerID, InvoiceNo, StockCode, InvoiceDate AS ts, TotalAmount AS amt FROM clean),
tl AS (
  SELECT CustomerID, count(*) AS n_lines, min(ts) AS first_ts, max(ts) AS last_ts,
         sum(amt) AS amount,
         count_if(isodow(ts) IN (6, 7)) AS weekend_lines,
         count_if(ts >= (SELECT analysis_date FROM ad) - INTERVAL 30 DAY) AS rn30,
         sum(CASE WHEN ts >= (SELECT analysis_date FROM ad) - INTERVAL 30 DAY THEN amt END) AS ra30,
         count_if(ts >= (SELECT analysis_date FROM ad) - INTERVAL 60 DAY) AS rn60,
         sum(CASE WHEN ts >= (SELECT analysis_date FROM ad) - INTERVAL 60 DAY THEN amt END) AS ra60,
         count_if(ts >= (SELECT analysis_date FROM ad) - INTERVAL 90 DAY) AS rn90,
         sum(CASE WHEN ts >= (SELECT analysis_date FROM ad) - INTERVAL 90 DAY THEN amt END) AS ra90,
         count(DISTINCT month(ts)) AS n_months,
         count(DISTINCT CAST(ts AS DATE)) AS n_days,
         count(DISTINCT StockCode) AS unique_products,
         date_sub('day', min(ts), max(ts)) AS span_days,
         epoch_us(max(ts)) - epoch_us(min(ts)) AS span_us
  FROM lines GROUP BY CustomerID
),
days AS (
  SELECT CustomerID, CAST(ts AS DATE) AS day, min(ts) AS first_ts, sum(amt) AS amt
  FROM lines GROUP BY CustomerID, CAST(ts AS DATE)
),
dw AS (
  SELECT *, row_number() OVER w - 1 AS idx,
         count(*) OVER (PARTITION BY CustomerID) AS nd,
         CAST(date_diff('day', lag(day) OVER w, day) AS DOUBLE) AS cal_gap,
         CAST(date_sub('day', lag(first_ts) OVER w, first_ts) AS DOUBLE) AS el_gap
  FROM days WINDOW w AS (PARTITION BY CustomerID ORDER BY day)
),
ds AS (
  SELECT CustomerID,
         avg(cal_gap) AS cal_avg, stddev_pop(cal_gap) AS cal_std,
         min(cal_gap) AS cal_min, max(cal_gap) AS cal_max,
         regr_slope(cal_gap, CAST(idx - 1 AS DOUBLE)) AS cal_slope,
         avg(el_gap) AS el_avg, stddev_pop(el_gap) AS el_std,
         regr_slope(el_gap, CAST(idx - 1 AS DOUBLE)) AS el_slope,
         regr_slope(CAST(amt AS DOUBLE), CAST(idx AS DOUBLE)) AS amt_slope,
         avg(CASE WHEN idx < nd // 2 THEN CAST(amt AS DOUBLE) END) AS past_avg,
         avg(CASE WHEN idx >= nd // 2 THEN CAST(amt AS DOUBLE) END) AS recent_avg
  FROM dw GROUP BY CustomerID
),
sp AS (
  SELECT l.CustomerID,
    count_if(3 * (epoch_us(l.ts) - epoch_us(t.first_ts)) <= t.span_days * 86400000000) AS t1_n,
    count_if(3 * (epoch_us(l.ts) - epoch_us(t.first_ts)) <= 2 * t.span_days * 86400000000) AS t2_n,
    count_if(2 * (epoch_us(l.ts) - epoch_us(t.first_ts)) <= t.span_us) AS half_n,
    sum(CASE WHEN 2 * (epoch_us(l.ts) - epoch_us(t.first_ts)) <= t.span_us THEN l.amt END) AS half_amt,
    count_if(2 * (epoch_us(l.ts) - epoch_us(t.first_ts)) <= t.span_days * 86400000000) AS chh_n,
    sum(CASE WHEN 2 * (epoch_us(l.ts) - epoch_us(t.first_ts)) <= t.span_days * 86400000000 THEN l.amt END) AS chh_amt
  FROM lines l JOIN tl t ON l.CustomerID = t.CustomerID
  GROUP BY l.CustomerID
),
ppo AS (
  SELECT CustomerID, avg(np) AS appo FROM (
    SELECT CustomerID, coalesce(InvoiceNo, 'nan') AS inv, count(DISTINCT StockCode) AS np
    FROM lines GROUP BY CustomerID, coalesce(InvoiceNo, 'nan')) GROUP BY CustomerID
),
st AS (
  SELECT tl.*, ds.* EXCLUDE (CustomerID), sp.* EXCLUDE (CustomerID), ppo.appo,
         CAST(n_lines AS DOUBLE) AS dn, CAST(amount AS DOUBLE) AS damt,
         CAST(span_days AS DOUBLE) AS dspan
  FROM tl JOIN ds USING (CustomerID) JOIN sp USING (CustomerID) JOIN ppo USING (CustomerID)
),
ts_feat AS (
  SELECT CustomerID,
    n_lines AS total_transactions,
    n_days AS unique_purchase_days,
    CASE WHEN n_lines < 2 THEN NULL WHEN n_days >= 2 THEN cal_avg ELSE 0.0 END AS avg_days_between_purchases,
    CASE WHEN n_lines < 2 THEN NULL WHEN n_days >= 2 THEN cal_std ELSE 0.0 END AS std_days_between_purchases,
    CASE WHEN n_lines < 2 THEN NULL WHEN n_days >= 2 THEN cal_min ELSE 0.0 END AS min_days_between_purchases,
    CASE WHEN n_lines < 2 THEN NULL WHEN n_days >= 2 THEN cal_max ELSE 0.0 END AS max_days_between_purchases,
    CASE WHEN n_lines < 2 THEN 0.0 WHEN n_days > 2 THEN coalesce(cal_slope, 0.0) ELSE 0.0 END AS purchase_interval_trend,
    CASE WHEN n_lines < 2 THEN 0.0 WHEN n_days >= 2 THEN coalesce(amt_slope, 0.0) ELSE 0.0 END AS purchase_amount_trend,
    CASE WHEN n_lines < 2 THEN NULL WHEN n_days >= 2 THEN recent_avg / (past_avg + 1.0) - 1.0 ELSE 0.0 END AS amount_trend_ratio,
    CASE WHEN n_lines < 2 THEN 0.0 WHEN span_days > 0 THEN
      CASE WHEN t1_n / greatest(dspan / 3.0, 1.0) > 0 THEN
        ((dn - t2_n) / greatest(dspan / 3.0, 1.0) - t1_n / greatest(dspan / 3.0, 1.0)) / (t1_n / greatest(dspan / 3.0, 1.0))
      ELSE 0.0 END
    ELSE 0.0 END AS frequency_trend,
    CASE WHEN n_lines < 2 THEN NULL WHEN span_days > 0 THEN
      ((dn - t2_n) / greatest(dspan / 3.0, 1.0) - (t2_n - t1_n) / greatest(dspan / 3.0, 1.0))
      - ((t2_n - t1_n) / greatest(dspan / 3.0, 1.0) - t1_n / greatest(dspan / 3.0, 1.0))
    ELSE 0.0 END AS frequency_acceleration,
    CASE WHEN n_lines < 2 THEN 0.0
         WHEN (CASE WHEN n_days >= 2 THEN cal_avg ELSE 0.0 END) > 0 THEN 1.0 / (1.0 + cal_std / cal_avg)
         ELSE 0.0 END AS purchase_regularity,
    CASE WHEN n_lines < 2 THEN 0.0 ELSE damt / greatest(dspan + 1.0, 1.0) END AS monetary_velocity,
    CASE WHEN n_lines < 2 THEN 0.0 ELSE rn30 / dn END AS recent_activity_ratio_30d,
    CASE WHEN n_lines < 2 THEN NULL WHEN rn30 > 0 THEN CAST(ra30 AS DOUBLE) / damt ELSE 0.0 END AS recent_monetary_ratio_30d,
    CASE WHEN n_lines < 2 THEN 0.0 ELSE rn60 / dn END AS recent_activity_ratio_60d,
    CASE WHEN n_lines < 2 THEN NULL WHEN rn60 > 0 THEN CAST(ra60 AS DOUBLE) / damt ELSE 0.0 END AS recent_monetary_ratio_60d,
    CASE WHEN n_lines < 2 THEN 0.0 ELSE rn90 / dn END AS recent_activity_ratio_90d,
    CASE WHEN n_lines < 2 THEN NULL WHEN rn90 > 0 THEN CAST(ra90 AS DOUBLE) / damt ELSE 0.0 END AS recent_monetary_ratio_90d,
    CASE WHEN n_lines < 2 THEN NULL ELSE weekend_lines / dn END AS weekend_purchase_ratio,
    CASE WHEN n_lines < 2 THEN NULL ELSE n_months / 12.0 END AS month_diversity,
    CASE WHEN n_lines < 2 THEN NULL ELSE unique_products END AS unique_products,
    CASE WHEN n_lines < 2 THEN NULL ELSE appo END AS avg_products_per_order
  FROM st
),
ch_feat AS (
  SELECT CustomerID,
    n_lines AS total_transactions, n_days AS unique_purchase_days, unique_products,
    CASE WHEN n_lines < 2 OR n_days < 2 THEN 999.0 ELSE el_avg END AS avg_days_between_purchases,
    CASE WHEN n_lines < 2 OR n_days < 2 THEN 0.0 ELSE el_std END AS std_days_between_purchases,
    CASE WHEN n_lines < 2 OR n_days < 2 THEN 0.0 WHEN n_days > 2 THEN coalesce(el_slope, 0.0) ELSE 0.0 END AS purchase_interval_trend,
    CASE WHEN n_lines < 2 OR span_days <= 0 THEN 0.0
         WHEN CAST(coalesce(chh_amt, 0) AS DOUBLE) > 0 THEN (damt - CAST(coalesce(chh_amt, 0) AS DOUBLE)) / CAST(coalesce(chh_amt, 0) AS DOUBLE) - 1.0
         ELSE 0.0 END AS monetary_trend,
    CASE WHEN n_lines < 2 OR span_days <= 0 THEN 0.0
         WHEN chh_n > 0 THEN (dn - chh_n) / CAST(chh_n AS DOUBLE) - 1.0 ELSE 0.0 END AS frequency_trend,
    CASE WHEN n_lines < 2 OR n_days < 2 THEN 0.0 WHEN el_avg > 0 THEN 1.0 / (1.0 + el_std / el_avg) ELSE 0.0 END AS purchase_regularity,
    CASE WHEN n_lines < 2 THEN 0.0 ELSE rn30 / dn END AS recent_activity_ratio_30d,
    CASE WHEN n_lines < 2 THEN 0.0 WHEN damt > 0 THEN CAST(coalesce(ra30, 0) AS DOUBLE) / damt ELSE 0.0 END AS recent_monetary_ratio_30d,
    CASE WHEN n_lines < 2 THEN 0.0 ELSE rn60 / dn END AS recent_activity_ratio_60d,
    CASE WHEN n_lines < 2 THEN 0.0 WHEN damt > 0 THEN CAST(coalesce(ra60, 0) AS DOUBLE) / damt ELSE 0.0 END AS recent_monetary_ratio_60d,
    CASE WHEN n_lines < 2 THEN 0.0 ELSE rn90 / dn END AS recent_activity_ratio_90d,
    CASE WHEN n_lines < 2 THEN 0.0 WHEN damt > 0 THEN CAST(coalesce(ra90, 0) AS DOUBLE) / damt ELSE 0.0 END AS recent_monetary_ratio_90d
  FROM st
),
half_tr AS (
  SELECT CustomerID,
    CASE WHEN n_lines < 2 THEN 0.0 WHEN half_n > 0 THEN (dn - half_n) / CAST(half_n AS DOUBLE) - 1.0 ELSE 0.0 END AS frequency_trend,
    CASE WHEN n_lines < 2 THEN 0.0
         WHEN CAST(coalesce(half_amt, 0) AS DOUBLE) > 0 THEN (damt - CAST(coalesce(half_amt, 0) AS DOUBLE)) / CAST(coalesce(half_amt, 0) AS DOUBLE) - 1.0
         ELSE 0.0 END AS monetary_trend,
    CASE WHEN n_lines < 2 THEN 0.0 WHEN n_days > 2 THEN coalesce(el_slope, 0.0) ELSE 0.0 END AS interval_trend
  FROM st
)"""


def seq_prefix(source: str = "orders", churn_days: int = 120) -> list[str]:
    return rfm_prefix(source, churn_days) + [SEQ]


def round_sql(expr: str, digits: int = 6) -> str:
    """Half-to-even rounding, the way numpy and pandas round."""
    scale = f"{10 ** digits}.0"
    return f"(round_even(CAST({expr} AS DOUBLE) * {scale}, 0) / {scale})"


def select_rounded(columns: list[tuple[str, bool]], source: str, digits: int = 6) -> str:
    """SELECT list where the flagged (double) columns are rounded half to even."""
    items = [f"{round_sql(c, digits)} AS {c}" if rnd else c for c, rnd in columns]
    return f"SELECT {', '.join(items)} FROM {source}"

# -- feature tables and the deterministic score ---------------------------------

SEGMENT_CODE_SQL = """CASE Segment WHEN 'Champions' THEN 11 WHEN 'Loyal Customers' THEN 10
      WHEN 'Potential Loyalists' THEN 9 WHEN 'New Customers' THEN 8 WHEN 'Promising' THEN 7
      WHEN 'Need Attention' THEN 6 WHEN 'About to Sleep' THEN 5 WHEN 'At Risk' THEN 4
      WHEN 'Cannot Lose Them' THEN 3 WHEN 'Hibernating' THEN 2 WHEN 'Lost' THEN 1 ELSE 0 END"""

SEGMENT_RISK_SQL = """CASE Segment WHEN 'Champions' THEN 1 WHEN 'Loyal Customers' THEN 2
      WHEN 'Potential Loyalists' THEN 3 WHEN 'Promising' THEN 3 WHEN 'New Customers' THEN 4
      WHEN 'Need Attention' THEN 5 WHEN 'About to Sleep' THEN 6 WHEN 'At Risk' THEN 7
      WHEN 'Cannot Lose Them' THEN 8 WHEN 'Hibernating' THEN 8 WHEN 'Lost' THEN 9 ELSE 5 END"""

TS_DATA = """
ts_d0 AS (
  SELECT r.CustomerID, r.Segment, r.Recency, r.Frequency, r.Monetary, r.mon,
         r.R_Score, r.F_Score, r.M_Score, r.is_high_value, r.avg_order_value,
         f.* EXCLUDE (CustomerID),
         r.R_Score * r.F_Score AS RF_Score, r.R_Score * r.M_Score AS RM_Score,
         r.F_Score * r.M_Score AS FM_Score, r.R_Score + r.F_Score + r.M_Score AS RFM_Score_Sum,
         date_sub('day', r.first_ts, r.analysis_date) AS customer_lifetime_days,
         r.Monetary / CAST(date_sub('day', r.first_ts, r.analysis_date) + 1 AS DOUBLE) AS lifetime_value_per_day,
         r.Monetary / (CAST(r.Frequency AS DOUBLE) * f.avg_days_between_purchases + 1.0) AS purchase_efficiency,
         CAST(coalesce(f.purchase_interval_trend > f.avg_days_between_purchases, false) AS INTEGER) AS interval_risk,
         CAST(coalesce(f.recent_activity_ratio_30d < 0.1, false) AS INTEGER) AS activity_risk,
         CAST(coalesce(f.amount_trend_ratio < -0.3, false) AS INTEGER) AS monetary_risk,
         CAST({segment_code} AS INTEGER) AS Segment_Encoded,
         CAST(r.Recency > {churn_days} AS INTEGER) AS is_churned
  FROM rfm r LEFT JOIN ts_feat f ON r.CustomerID = f.CustomerID
),
ts_data AS (
  SELECT *, interval_risk + activity_risk + monetary_risk AS risk_score,
         floor((1.0 - coalesce(recent_activity_ratio_90d, 0.0)) * 1000000.0 + 0.5) / 1000000.0 AS churn_probability
  FROM ts_d0
)"""

CH_DATA = """
ch_d0 AS (
  SELECT r.CustomerID, r.Segment, r.Recency, r.Frequency, r.Monetary, r.mon,
         r.F_Score, r.M_Score, r.is_high_value, r.is_churned,
         f.* EXCLUDE (CustomerID),
         r.F_Score * r.M_Score AS FM_Score,
         r.F_Score * r.F_Score AS F_Score_squared, r.M_Score * r.M_Score AS M_Score_squared,
         CAST(coalesce(f.purchase_interval_trend > 10, false) AS INTEGER) AS interval_risk,
         CAST(coalesce(f.recent_activity_ratio_30d < 0.1, false) AS INTEGER) AS activity_risk,
         CAST(coalesce(f.monetary_trend < -0.3, false) AS INTEGER) AS monetary_risk,
         CAST(coalesce(f.frequency_trend < -0.3, false) AS INTEGER) AS frequency_risk,
         CAST({segment_risk} AS INTEGER) AS segment_risk_level,
         CAST(r.F_Score AS DOUBLE) * 0.3 + CAST(r.M_Score AS DOUBLE) * 0.7 AS customer_value_score,
         r.Monetary / CAST(r.Frequency + 1 AS DOUBLE) AS avg_order_value,
         date_sub('day', r.first_ts, r.analysis_date) AS lifetime_days,
         r.Monetary / CAST(date_sub('day', r.first_ts, r.analysis_date) + 1 AS DOUBLE) AS lifetime_value_per_day
  FROM rfm r LEFT JOIN ch_feat f ON r.CustomerID = f.CustomerID
),
ch_data AS (
  SELECT *, interval_risk + activity_risk + monetary_risk + frequency_risk AS risk_score,
         floor((1.0 - coalesce(recent_activity_ratio_90d, 0.0)) * 1000000.0 + 0.5) / 1000000.0 AS churn_probability
  FROM ch_d0
)"""


def data_prefix(source: str = "orders", churn_days: int = 120) -> list[str]:
    ts = (TS_DATA.replace("{segment_code}", SEGMENT_CODE_SQL)
          .replace("{churn_days}", str(churn_days)))
    ch = CH_DATA.replace("{segment_risk}", SEGMENT_RISK_SQL)
    return seq_prefix(source, churn_days) + [ts, ch]
