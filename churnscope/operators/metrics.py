"""Evaluation over ``(label, score)`` as distributed SQL (V1-V7).

Curves and AUC need the scores in order. The rows are first reduced to
one row per distinct score with positive / negative counts (map-side
combined), then cumulative counts are taken with the range-partitioned
running total; nothing is sorted in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.functions.columns import safe_div
from churnscope.operators.ranking import running_total


def score_counts(df: DataFrame, label: str = "is_churned",
                 score: str = "churn_probability") -> DataFrame:
    return (df.groupBy(F.col(score).alias("score"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"),
                 F.count_if(F.col(label) == 0).alias("neg")))


def _cumulative(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: pos, neg, cumulative pos/neg up to and including
    the score (ascending), and class totals P, N."""
    sc = score_counts(df, label, score)
    cum = running_total(sc, ["score"], ["pos", "neg"], ["cpos", "cneg"])
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return cum.crossJoin(F.broadcast(tot))


def auc(df: DataFrame, label: str = "is_churned",
        score: str = "churn_probability") -> DataFrame:
    """V1: ROC AUC with ties counted half (Mann-Whitney), one row. The
    numerator is an exact integer (twice the statistic)."""
    c = _cumulative(df, label, score)
    below = F.col("cneg") - F.col("neg")
    twice = F.sum(2 * F.col("pos") * below + F.col("pos") * F.col("neg"))
    return c.agg(twice.alias("_u2"), F.max("P").alias("_p"), F.max("N").alias("_n")).select(
        safe_div(F.col("_u2").cast("double"),
                 (2 * F.col("_p") * F.col("_n")).cast("double")).alias("auc"))


def roc_points(df: DataFrame, label: str = "is_churned",
               score: str = "churn_probability") -> DataFrame:
    """V4: (fpr, tpr) at every distinct score used as a ``>=`` threshold."""
    c = _cumulative(df, label, score)
    tp = F.col("P") - (F.col("cpos") - F.col("pos"))
    fp = F.col("N") - (F.col("cneg") - F.col("neg"))
    return c.select(F.col("score").alias("threshold"),
                    safe_div(fp.cast("double"), F.col("N").cast("double")).alias("fpr"),
                    safe_div(tp.cast("double"), F.col("P").cast("double")).alias("tpr"))


def pr_points(df: DataFrame, label: str = "is_churned",
              score: str = "churn_probability") -> DataFrame:
    """V5: precision and recall at every distinct score threshold."""
    c = _cumulative(df, label, score)
    tp = F.col("P") - (F.col("cpos") - F.col("pos"))
    fp = F.col("N") - (F.col("cneg") - F.col("neg"))
    return c.select(F.col("score").alias("threshold"),
                    safe_div(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
                    safe_div(tp.cast("double"), F.col("P").cast("double")).alias("recall"))


def best_f1_threshold(df: DataFrame, label: str = "is_churned",
                      score: str = "churn_probability") -> DataFrame:
    """V6: threshold maximising 2PR/(P+R+1e-10); the lowest wins ties."""
    pr = pr_points(df, label, score)
    f1 = F.lit(2.0) * (F.col("precision") * F.col("recall")) / (
        F.col("precision") + F.col("recall") + F.lit(1e-10))
    return (pr.withColumn("f1", f1).orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
            .select("threshold", "f1", "precision", "recall"))


def classification_metrics(df: DataFrame, label: str = "is_churned",
                           pred: str | None = None, score: str = "churn_probability",
                           threshold: float = 0.5) -> DataFrame:
    """V2: precision, recall, F1, accuracy of the predicted class (``pred``
    column, or ``score > threshold`` — the class with the larger
    probability); 0 on an empty denominator."""
    p = F.col(pred) == 1 if pred else F.col(score) > threshold
    y = F.col(label) == 1
    g = df.agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"),
               F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn"))
    d = lambda c: F.col(c).cast("double")
    return g.select(
        F.coalesce(safe_div(d("tp"), d("tp") + d("fp")), F.lit(0.0)).alias("precision"),
        F.coalesce(safe_div(d("tp"), d("tp") + d("fn")), F.lit(0.0)).alias("recall"),
        F.coalesce(safe_div(2.0 * d("tp"), 2.0 * d("tp") + d("fp") + d("fn")), F.lit(0.0)).alias("f1"),
        safe_div(d("tp") + d("tn"), d("tp") + d("tn") + d("fp") + d("fn")).alias("accuracy"))


def confusion(df: DataFrame, label: str = "is_churned", pred: str | None = None,
              score: str = "churn_probability", threshold: float = 0.5) -> DataFrame:
    """V3: the 2×2 matrix as four rows (zero-filled)."""
    spark = df.sparkSession
    p = (F.col(pred) if pred else (F.col(score) > threshold).cast("int")).alias("predicted")
    cells = spark.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)],
                                  "actual int, predicted int")
    g = df.groupBy(F.col(label).cast("int").alias("actual"), p.cast("int")).agg(
        F.count(F.lit(1)).alias("customers"))
    return (cells.join(g, ["actual", "predicted"], "left")
            .withColumn("customers", F.coalesce(F.col("customers"), F.lit(0)).cast("bigint")))


def correlations(df: DataFrame, features: list[str],
                 target: str = "churn_probability") -> DataFrame:
    """V7: Pearson correlation of each feature with the target, one row per
    feature (present features only)."""
    present = [f for f in features if f in df.columns]
    one = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f)
                   for f in present])
    return one.unpivot([], present, "feature", "correlation")
