"""Cleaning (P1-P12) and the data-quality profile (Q1-Q9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.functions.columns import elapsed_days, is_return, safe_div, to_double, units
from churnscope.operators.ranking import exact_quantiles_of


def drop_missing_customers(tx: DataFrame) -> DataFrame:
    """P1."""
    return tx.filter(F.col("CustomerID").isNotNull())


def valid_sales(tx: DataFrame, country: str | None = None) -> DataFrame:
    """P3 + P4 + P5: positive quantity and price, not a return, known
    customer, optional country scope; adds ``TotalAmount`` (exact decimal)
    and ``amount_units`` (the same amount as a bigint, used by aggregates).

    On a table of invoice lines the predicates are comparisons on scan
    columns and reach the reader; on the joined test tables only the null
    tests can."""
    cond = ((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0)
            & ~is_return("InvoiceNo") & F.col("CustomerID").isNotNull())
    if country is not None:
        cond = cond & (F.col("Country") == F.lit(country))
    return (tx.filter(cond)
            .withColumn("TotalAmount", F.col("Quantity").cast("decimal(10,0)") * F.col("UnitPrice"))
            .withColumn("amount_units", units(F.col("UnitPrice"), F.col("Quantity"))))


def returns_sample(tx: DataFrame, n: int | None = 5) -> DataFrame:
    """Return lines (of known customers), four columns; ``n`` rows in a
    deterministic order, or all of them when ``n`` is None."""
    out = (drop_missing_customers(tx).filter(is_return("InvoiceNo"))
           .select("InvoiceNo", "Quantity",
                   to_double(F.col("UnitPrice")).alias("UnitPrice"), "CustomerID"))
    if n is None:
        return out
    return out.orderBy("InvoiceNo", "CustomerID", "Quantity", "UnitPrice").limit(n)


def profile(tx: DataFrame) -> DataFrame:
    """Q1-Q6 as one row: counts of rows, missing customers, anomalies and
    returns, distinct customers in each scope, date range and span.

    Distinct customers come from a per-customer pre-aggregate (map-side
    combined, one shuffle) instead of three ``count(distinct)`` over the
    raw lines, which would expand every line three times before shuffling.
    """
    known = F.col("CustomerID").isNotNull()
    valid = ((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0) & ~is_return("InvoiceNo"))
    ret = is_return("InvoiceNo")
    per = tx.groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("InvoiceDate").alias("first"), F.max("InvoiceDate").alias("last"),
        F.count_if(F.col("Quantity") < 0).alias("neg_q"),
        F.count_if(F.col("UnitPrice") <= 0).alias("bad_p"),
        F.count_if(ret).alias("ret"), F.count_if(valid).alias("valid"))
    agg = per.agg(
        F.sum("rows").alias("raw_rows"),
        F.sum(F.when(~known, F.col("rows")).otherwise(0)).alias("null_customers"),
        F.count_if(known).alias("raw_customers"),
        F.sum(F.when(known, F.col("rows")).otherwise(0)).alias("rows_with_customer"),
        F.min(F.when(known, F.col("first"))).alias("first_date"),
        F.max(F.when(known, F.col("last"))).alias("last_date"),
        F.sum(F.when(known, F.col("neg_q")).otherwise(0)).alias("negative_quantity"),
        F.sum(F.when(known, F.col("bad_p")).otherwise(0)).alias("nonpositive_price"),
        F.sum(F.when(known, F.col("ret")).otherwise(0)).alias("return_lines"),
        F.count_if(known & (F.col("ret") > 0)).alias("return_customers"),
        F.sum(F.when(known, F.col("valid")).otherwise(0)).alias("valid_rows"),
        F.count_if(known & (F.col("valid") > 0)).alias("valid_customers"))
    return agg.select(
        F.col("raw_rows").cast("bigint").alias("raw_rows"),
        F.col("null_customers").cast("bigint").alias("null_customers"),
        "raw_customers",
        F.col("rows_with_customer").cast("bigint").alias("rows_with_customer"),
        (F.col("raw_rows") - F.col("rows_with_customer")).cast("bigint").alias("removed_rows"),
        "first_date", "last_date",
        elapsed_days(F.col("first_date"), F.col("last_date")).alias("span_days"),
        F.col("negative_quantity").cast("bigint").alias("negative_quantity"),
        F.col("nonpositive_price").cast("bigint").alias("nonpositive_price"),
        F.col("return_lines").cast("bigint").alias("return_lines"),
        "return_customers",
        F.col("valid_rows").cast("bigint").alias("valid_rows"),
        "valid_customers")


def describe_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q7: count, mean, sample std, min, quartiles (linear), max per column,
    one row per column: one pass for the moments, one for the quartiles of all
    columns, which are exact and distributed (``exact_quantiles_of``)."""
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    one = x.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, f in (
        ("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("_m"), F.lit(c).alias("column"), *[
        F.col(f"{n}_{i}").alias(n) for n in ("count", "mean", "std", "min", "max")]) for i, c in enumerate(cols)])).alias("r")
    quartiles = exact_quantiles_of(x, cols, [0.25, 0.5, 0.75])
    return one.select(rows).select("r.*").join(quartiles, "_m", "left").select(
        "column", F.col("count").cast("bigint").alias("count"), "mean", "std", "min",
        F.col("q_0").alias("p25"), F.col("q_1").alias("p50"), F.col("q_2").alias("p75"), "max")


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Q8: most frequent values (ties by value), ``n`` rows."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("lines"))
            .orderBy(F.desc("lines"), F.asc(col)).limit(n))


def value_share(df: DataFrame, col: str, value) -> DataFrame:
    """Q9: share of rows whose ``col`` equals ``value`` (one row)."""
    return df.agg(safe_div(F.count_if(F.col(col) == F.lit(value)).cast("double"),
                           F.count(F.lit(1)).cast("double")).alias("share"))
