"""Per-customer sequence features: RFM trends (W1-W8), time-series step
(F1-F19) and integrated step (G1-G8).

The original code filters the whole transaction table once per customer
and loops in Python. Here every feature comes from a few shared grains,
and no operation is keyed by customer alone over raw lines:

* ``ts grain`` (customer, timestamp): lines and amount, map-side combined.
* ``day grain`` (customer, date): first time of day, lines, amount. A
  customer has at most one row per calendar day, so the only per-customer
  window (lag / row_number over dates) is bounded by the calendar span,
  never by how many lines a heavy customer has.
* split counts (first half / thirds of a customer's time span) are summed
  per day for whole days and only the day that contains the cut looks at
  individual timestamps, through a join keyed by (customer, date).
* invoice and product grains for the distinct counts.

All aggregates are plain ``groupBy`` with partial aggregation, so a
customer holding a large share of all lines is pre-aggregated in every
task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnscope.config import DEFAULT
from churnscope.functions.columns import (
    calendar_days, elapsed_days, micros_between, money, safe_div, to_double)

C = "CustomerID"
DAY_US = 86_400_000_000


# --------------------------------------------------------------------------
# grains
# --------------------------------------------------------------------------

def ts_grain(clean: DataFrame) -> DataFrame:
    """(customer, timestamp) → lines, amount."""
    return (clean.groupBy(C, F.col("InvoiceDate").alias("ts"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("amount_units").alias("amt"))
            .withColumn("day", F.to_date("ts")))


def day_grain(tsg: DataFrame) -> DataFrame:
    """(customer, date) → first time of the day, lines, amount."""
    return tsg.groupBy(C, "day").agg(
        F.min("ts").alias("first_ts"), F.sum("n").alias("n"), F.sum("amt").alias("amt"))


def daily_purchases(clean: DataFrame) -> DataFrame:
    """the daily table of the time-series step — amount and distinct
    orders per (customer, date). A missing invoice number counts as the
    text ``nan``, as the original casts it to string first."""
    inv = F.coalesce(F.col("InvoiceNo"), F.lit("nan"))
    return (clean.groupBy(C, F.to_date("InvoiceDate").alias("Date"))
            .agg(money(F.sum("amount_units")).alias("Amount"),
                 F.count_distinct(inv).alias("Orders")))


def product_stats(clean: DataFrame) -> DataFrame:
    """Distinct products per customer and mean distinct
    products per invoice (missing invoice → ``nan``)."""
    inv = F.coalesce(F.col("InvoiceNo"), F.lit("nan")).alias("inv")
    per_invoice = (clean.groupBy(C, inv)
                   .agg(F.count_distinct("StockCode").alias("products")))
    ppo = per_invoice.groupBy(C).agg(F.avg("products").alias("avg_products_per_order"))
    uniq = clean.groupBy(C).agg(F.count_distinct("StockCode").alias("unique_products"))
    return uniq.join(ppo, C)


def timeline(tsg: DataFrame, ad: DataFrame, windows=DEFAULT.windows) -> DataFrame:
    """Per-customer totals from the ts grain (no distinct counts): lines,
    first/last time, amount, weekend lines, recent lines and amounts."""
    x = tsg.crossJoin(F.broadcast(ad))
    weekend = F.weekday("ts").isin(5, 6)
    aggs = [F.sum("n").alias("n_lines"), F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"), F.sum("amt").alias("amount"),
            F.sum(F.when(weekend, F.col("n")).otherwise(0)).alias("weekend_lines"),
            F.first("analysis_date").alias("analysis_date")]
    for d in windows:
        recent = F.col("ts") >= F.col("analysis_date") - F.expr(f"INTERVAL {int(d)} DAYS")
        aggs += [F.sum(F.when(recent, F.col("n")).otherwise(0)).alias(f"recent_n_{d}"),
                 F.sum(F.when(recent, F.col("amt"))).alias(f"recent_amt_{d}")]
    out = x.groupBy(C).agg(*aggs)
    return (out.withColumn("span_days", elapsed_days(F.col("first_ts"), F.col("last_ts")))
            .withColumn("span_us", micros_between(F.col("first_ts"), F.col("last_ts"))))


def day_stats(dg: DataFrame) -> DataFrame:
    """Interval and daily-amount statistics from the day grain.

    * calendar-day gaps between purchase dates (time-series step),
    * elapsed whole days between the first purchase of consecutive days
      (RFM and integrated steps),
    * least-squares slopes on the 0-based index, the half-split of daily
      amounts, and the number of distinct calendar months.
    """
    w = Window.partitionBy(C).orderBy("day")
    whole = Window.partitionBy(C)
    g = (dg.withColumn("idx", F.row_number().over(w) - 1)
         .withColumn("n_days_c", F.count(F.lit(1)).over(whole))
         .withColumn("cal_gap", calendar_days(F.lag("day").over(w), F.col("day")).cast("double"))
         .withColumn("el_gap", elapsed_days(F.lag("first_ts").over(w), F.col("first_ts")).cast("double")))
    amt = money(F.col("amt"))
    gap_idx = (F.col("idx") - 1).cast("double")
    half = F.floor(F.col("n_days_c") / 2)
    return g.groupBy(C).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.avg("cal_gap").alias("cal_avg"), F.stddev_pop("cal_gap").alias("cal_std"),
        F.min("cal_gap").alias("cal_min"), F.max("cal_gap").alias("cal_max"),
        F.regr_slope("cal_gap", gap_idx).alias("cal_slope"),
        F.avg("el_gap").alias("el_avg"), F.stddev_pop("el_gap").alias("el_std"),
        F.regr_slope("el_gap", gap_idx).alias("el_slope"),
        F.regr_slope(amt, F.col("idx").cast("double")).alias("amt_slope"),
        F.avg(F.when(F.col("idx") < half, amt)).alias("past_avg_amt"),
        F.avg(F.when(F.col("idx") >= half, amt)).alias("recent_avg_amt"),
        F.count_distinct(F.month("day")).alias("n_months"))


def _cuts(tl: DataFrame) -> DataFrame:
    """One row per (customer, cut). A line is *before* cut k when
    ``mult · µs(first_ts → ts) <= bound``:

    * ``half``  exact time midpoint (RFM step): 2·Δ <= span
    * ``chh``   first + ⌊days⌋/2 days (integrated step): 2·Δ <= days·86400e6
    * ``t1``/``t2`` first + ⌊days⌋/3 and 2⌊days⌋/3 days (time-series step)
    """
    span_d = F.col("span_days") * F.lit(DAY_US)
    cuts = F.array(
        F.struct(F.lit("half").alias("cut"), F.lit(2).cast("bigint").alias("mult"),
                 F.col("span_us").alias("bound")),
        F.struct(F.lit("chh").alias("cut"), F.lit(2).cast("bigint").alias("mult"),
                 span_d.alias("bound")),
        F.struct(F.lit("t1").alias("cut"), F.lit(3).cast("bigint").alias("mult"),
                 span_d.alias("bound")),
        F.struct(F.lit("t2").alias("cut"), F.lit(3).cast("bigint").alias("mult"),
                 (span_d * 2).alias("bound")))
    x = tl.select(C, "first_ts", F.explode(cuts).alias("k")).select(
        C, "first_ts", "k.cut", "k.mult", "k.bound")
    # the calendar day holding the cut instant
    cut_day = F.to_date(F.timestamp_add(
        "MICROSECOND", F.floor(F.col("bound") / F.col("mult")), F.col("first_ts")))
    return x.withColumn("cut_day", cut_day)


def split_stats(tsg: DataFrame, dg: DataFrame, tl: DataFrame) -> DataFrame:
    """Lines and amount before each cut, per customer (columns
    ``<cut>_n`` and ``<cut>_amt``)."""
    cuts = _cuts(tl)
    # whole days strictly before the cut day (day grain: bounded per customer)
    whole = (dg.join(cuts.select(C, "cut", "cut_day"), C)
             .filter(F.col("day") < F.col("cut_day"))
             .select(C, "cut", "n", "amt"))
    # the cut day itself, timestamp by timestamp: keyed by (customer, day)
    edge = (tsg.join(cuts.withColumnRenamed("cut_day", "day"), [C, "day"])
            .filter(F.col("mult") * micros_between(F.col("first_ts"), F.col("ts")) <= F.col("bound"))
            .select(C, "cut", "n", "amt"))
    before = whole.unionByName(edge).groupBy(C).pivot("cut", ["half", "chh", "t1", "t2"]).agg(
        F.sum("n").alias("n"), F.sum("amt").alias("amt"))
    return before


def sequence_stats(clean: DataFrame, ad: DataFrame | None = None,
                   windows=DEFAULT.windows, write_grain: bool = True) -> DataFrame:
    """All raw per-customer sequence statistics, one row per customer.
    Without ``ad`` the analysis date comes from the ts grain itself.

    The (customer, timestamp) grain feeds three aggregates (totals, day
    grain, cut-day detail); with ``write_grain`` it is written once to the
    checkpoint folder instead of being re-aggregated by each of them."""
    from churnscope.operators.ranking import materialize
    tsg = ts_grain(clean)
    if write_grain:
        tsg = materialize(tsg, "ts-grain")
    if ad is None:
        ad = tsg.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz")
                     .alias("analysis_date"))
    dg = day_grain(tsg)
    tl = timeline(tsg, ad, windows)
    out = (tl.join(day_stats(dg), C)
           .join(split_stats(tsg, dg, tl), C, "left")
           .join(product_stats(clean), C))
    fills = {f"{c}_{m}": 0 for c in ("half", "chh", "t1", "t2") for m in ("n",)}
    return out.fillna(fills)


# --------------------------------------------------------------------------
# feature sets
# --------------------------------------------------------------------------

def _small():
    return F.col("n_lines") < 2


def _d(col: str):
    return to_double(F.col(col))


def _m(col: str):
    """An exact amount as currency."""
    return money(F.col(col))


def half_trends(stats: DataFrame) -> DataFrame:
    """Exact-midpoint trends of the RFM step (all customers; the
    original samples 1,000 of them, see ``sample_customers``)."""
    n1 = _d("half_n")
    n2 = _d("n_lines") - n1
    a1 = money(F.coalesce(F.col("half_amt"), F.lit(0)))
    a2 = _m("amount") - a1
    small = _small()
    freq = F.when(small, 0.0).when(n1 > 0, n2 / n1 - 1).otherwise(0.0)
    mon = F.when(small, 0.0).when(a1 > 0, a2 / a1 - 1).otherwise(0.0)
    itv = F.when(small, 0.0).when(F.col("n_days") > 2, F.coalesce(F.col("el_slope"), F.lit(0.0))).otherwise(0.0)
    return stats.select(C, freq.alias("frequency_trend"), mon.alias("monetary_trend"),
                        itv.alias("interval_trend"))


TS_FEATURES = [
    "total_transactions", "unique_purchase_days", "avg_days_between_purchases",
    "std_days_between_purchases", "min_days_between_purchases",
    "max_days_between_purchases", "purchase_interval_trend", "purchase_amount_trend",
    "amount_trend_ratio", "frequency_trend", "frequency_acceleration",
    "purchase_regularity", "monetary_velocity",
    "recent_activity_ratio_30d", "recent_monetary_ratio_30d",
    "recent_activity_ratio_60d", "recent_monetary_ratio_60d",
    "recent_activity_ratio_90d", "recent_monetary_ratio_90d",
    "weekend_purchase_ratio", "month_diversity", "unique_products",
    "avg_products_per_order",
]


def features_ts(stats: DataFrame, windows=DEFAULT.windows) -> DataFrame:
    """F1-F19. Customers with fewer than two lines get the original's
    defaults: 0 for the keys it sets, NULL for the keys it leaves out
    (filled with 0 only when the feature matrix is built)."""
    small = _small()
    none = F.lit(None).cast("double")
    has_gap = F.col("n_days") >= 2

    def gap(col):
        return F.when(small, none).when(has_gap, F.col(col)).otherwise(0.0)

    avg = gap("cal_avg")
    std = gap("cal_std")
    span = _d("span_days")
    third = span / 3.0
    den = F.greatest(third, F.lit(1.0))
    f1 = _d("t1_n") / den
    f2 = (_d("t2_n") - _d("t1_n")) / den
    f3 = (_d("n_lines") - _d("t2_n")) / den
    cols = {
        "total_transactions": F.col("n_lines"),
        "unique_purchase_days": F.col("n_days"),
        "avg_days_between_purchases": avg,
        "std_days_between_purchases": std,
        "min_days_between_purchases": gap("cal_min"),
        "max_days_between_purchases": gap("cal_max"),
        "purchase_interval_trend": F.when(small, 0.0).when(
            F.col("n_days") > 2, F.coalesce(F.col("cal_slope"), F.lit(0.0))).otherwise(0.0),
        "purchase_amount_trend": F.when(small, 0.0).when(
            has_gap, F.coalesce(F.col("amt_slope"), F.lit(0.0))).otherwise(0.0),
        "amount_trend_ratio": F.when(small, none).when(
            has_gap, F.col("recent_avg_amt") / (F.col("past_avg_amt") + 1.0) - 1.0).otherwise(0.0),
        "frequency_trend": F.when(small, 0.0).when(
            F.col("span_days") > 0, F.when(f1 > 0, (f3 - f1) / f1).otherwise(0.0)).otherwise(0.0),
        "frequency_acceleration": F.when(small, none).when(
            F.col("span_days") > 0, (f3 - f2) - (f2 - f1)).otherwise(0.0),
        "purchase_regularity": F.when(small, 0.0).when(
            avg > 0, 1.0 / (1.0 + std / avg)).otherwise(0.0),
        "monetary_velocity": F.when(small, 0.0).otherwise(
            _m("amount") / F.greatest(span + 1.0, F.lit(1.0))),
        "weekend_purchase_ratio": F.when(small, none).otherwise(_d("weekend_lines") / _d("n_lines")),
        "month_diversity": F.when(small, none).otherwise(_d("n_months") / 12.0),
        "unique_products": F.when(small, F.lit(None).cast("bigint")).otherwise(F.col("unique_products")),
        "avg_products_per_order": F.when(small, none).otherwise(F.col("avg_products_per_order")),
    }
    for d in windows:
        rn, ra = f"recent_n_{d}", f"recent_amt_{d}"
        cols[f"recent_activity_ratio_{d}d"] = F.when(small, 0.0).otherwise(_d(rn) / _d("n_lines"))
        cols[f"recent_monetary_ratio_{d}d"] = F.when(small, none).when(
            F.col(rn) > 0, safe_div(_m(ra), _m("amount"))).otherwise(0.0)
    names = [c for c in TS_FEATURES if c in cols] + [
        k for k in cols if k not in TS_FEATURES]
    return stats.select(C, *[cols[k].alias(k) for k in names])


CH_FEATURES = [
    "total_transactions", "unique_purchase_days", "unique_products",
    "avg_days_between_purchases", "std_days_between_purchases",
    "purchase_interval_trend", "monetary_trend", "frequency_trend",
    "purchase_regularity",
    "recent_activity_ratio_30d", "recent_monetary_ratio_30d",
    "recent_activity_ratio_60d", "recent_monetary_ratio_60d",
    "recent_activity_ratio_90d", "recent_monetary_ratio_90d",
]


def features_ch(stats: DataFrame, windows=DEFAULT.windows) -> DataFrame:
    """The integrated step's variant (elapsed-day gaps between first
    purchases of days, 999 when there is no gap, split at ⌊days⌋/2)."""
    small = _small()
    has_gap = F.col("n_days") >= 2
    avg = F.when(small | ~has_gap, F.lit(999.0)).otherwise(F.col("el_avg"))
    std = F.when(small | ~has_gap, F.lit(0.0)).otherwise(F.col("el_std"))
    n1 = _d("chh_n")
    n2 = _d("n_lines") - n1
    a1 = money(F.coalesce(F.col("chh_amt"), F.lit(0)))
    a2 = _m("amount") - a1
    spread = F.col("span_days") > 0
    cols = {
        "total_transactions": F.col("n_lines"),
        "unique_purchase_days": F.col("n_days"),
        "unique_products": F.col("unique_products"),
        "avg_days_between_purchases": avg,
        "std_days_between_purchases": std,
        "purchase_interval_trend": F.when(small | ~has_gap, 0.0).when(
            F.col("n_days") > 2, F.coalesce(F.col("el_slope"), F.lit(0.0))).otherwise(0.0),
        "monetary_trend": F.when(small | ~spread, 0.0).when(a1 > 0, a2 / a1 - 1.0).otherwise(0.0),
        "frequency_trend": F.when(small | ~spread, 0.0).when(n1 > 0, n2 / n1 - 1.0).otherwise(0.0),
        "purchase_regularity": F.when(small | ~has_gap, 0.0).when(
            avg > 0, 1.0 / (1.0 + std / avg)).otherwise(0.0),
    }
    for d in windows:
        rn, ra = f"recent_n_{d}", f"recent_amt_{d}"
        cols[f"recent_activity_ratio_{d}d"] = F.when(small, 0.0).otherwise(_d(rn) / _d("n_lines"))
        cols[f"recent_monetary_ratio_{d}d"] = F.when(small, 0.0).when(
            _m("amount") > 0, F.coalesce(_m(ra), F.lit(0.0)) / _m("amount")).otherwise(0.0)
    return stats.select(C, *[cols[k].alias(k) for k in cols])


def trend_summary(trends: DataFrame) -> DataFrame:
    """Customers with falling frequency, falling spend, widening gaps."""
    return trends.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("frequency_trend") < -0.3).alias("frequency_decline"),
        F.count_if(F.col("monetary_trend") < -0.3).alias("monetary_decline"),
        F.count_if(F.col("interval_trend") > 10).alias("interval_increase"))


def sample_customers(rfm: DataFrame, n: int = 1000, seed: int = DEFAULT.seed,
                     min_frequency: int = 2) -> DataFrame:
    """A reproducible sample of ``n`` customers with Frequency ≥ 2,
    chosen by a seeded hash (no RNG state; a top-k, not a global sort)."""
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.col(C).cast("string")))
    return (rfm.filter(F.col("Frequency") >= min_frequency)
            .select(C, key.alias("_k")).orderBy("_k", C).limit(n).select(C))
