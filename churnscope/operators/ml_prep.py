"""Split, scale, weight and balance the customer table (M1-M6).

The split is deterministic: customers are ordered inside their class by a
seeded MD5 of the key (no RNG state, identical on every rerun and in any
engine), and exact per-class cut counts follow the two-step 70/15/15
scheme of the original. Ranks come from the distributed ``global_rank``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnscope.config import DEFAULT
from churnscope.operators.neighbours import nearest
from churnscope.operators.ranking import global_rank

C = "CustomerID"


def split_key(seed: int = DEFAULT.seed):
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(C).cast("string")))


def split_sizes(fractions: tuple[float, float, float]) -> dict[str, float]:
    """``stratified_split`` arguments of (train, validation, test) shares."""
    train, val, test = fractions
    if min(fractions) <= 0 or abs(train + val + test - 1.0) > 1e-9:
        raise ValueError("the three shares must be positive and add up to 1")
    held = round(val + test, 12)
    return {"test_size": held, "test_share_of_rest": round(test / held, 12)}


def stratified_split(df: DataFrame, label: str = "is_churned", test_size: float = 0.3,
                     test_share_of_rest: float = 0.5, seed: int = DEFAULT.seed) -> DataFrame:
    """M1: adds ``split`` ∈ {train, val, test}. Per class of size n:
    ``ceil(test_size·n)`` leave training, ``ceil(share·that)`` of them go to
    test and the rest to validation."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    before = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    held = F.ceil(F.lit(test_size) * F.col("_nc").cast("double"))
    test = F.ceil(F.lit(test_share_of_rest) * held.cast("double"))
    # one row per class: size-bounded by the number of classes
    cuts = counts.select(
        label,
        F.coalesce(F.sum("_nc").over(before), F.lit(0)).alias("_off"),
        (F.col("_nc") - held).alias("_train"),
        (held - test).alias("_val"))
    ranked = global_rank(df.withColumn("_k", split_key(seed)), [F.col(label), F.col("_k"), F.col(C)],
                         "_rk")
    r = F.col("_rk") - F.col("_off")
    return (ranked.join(F.broadcast(cuts), label)
            .withColumn("split", F.when(r <= F.col("_train"), "train")
                        .when(r <= F.col("_train") + F.col("_val"), "val").otherwise("test"))
            .drop("_k", "_rk", "_off", "_train", "_val"))


def split_summary(split: DataFrame, label: str = "is_churned") -> DataFrame:
    """M2: size and churn rate per split."""
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("customers"),
        (F.sum(label).cast("double") / F.count(F.lit(1)).cast("double")).alias("churn_rate"))


def scaler_stats(train: DataFrame, cols: list[str]) -> DataFrame:
    """M3: mean and population std of each feature on the training rows,
    one row per feature (one aggregate pass, then unpivot)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    one = train.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"),
                                        F.col(f"s{i}").alias("std")) for i, c in enumerate(cols)]))
    return one.select(rows.alias("r")).select("r.feature", "r.mean", "r.std")


def standardize(df: DataFrame, stats: DataFrame, cols: list[str]) -> DataFrame:
    """Apply (x - mean) / std (std 0 → scale 1, as the original scaler)."""
    wide = stats.groupBy().pivot("feature", cols).agg(F.first("mean").alias("m"),
                                                       F.first("std").alias("s"))
    out = df.crossJoin(F.broadcast(wide))  # one row

    def z(c: str):
        s = F.col(f"{c}_s")
        return ((F.col(c).cast("double") - F.col(f"{c}_m"))
                / F.when((s == 0) | s.isNull(), F.lit(1.0)).otherwise(s)).alias(c)
    return out.select(*[z(c) if c in cols else F.col(c) for c in df.columns])


def class_weights(train: DataFrame, label: str = "is_churned") -> DataFrame:
    """M4 + M5: ``balanced`` weights n / (2·n_class) per class, and the
    positive-class weight neg / max(pos, 1) of the boosted model."""
    g = train.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n_class"))
    total = F.sum("n_class").over(Window.partitionBy())
    neg = F.sum(F.when(F.col("label") == 0, F.col("n_class")).otherwise(0)).over(Window.partitionBy())
    pos = F.sum(F.when(F.col("label") == 1, F.col("n_class")).otherwise(0)).over(Window.partitionBy())
    return g.select("label", "n_class",
                    (total.cast("double") / (2.0 * F.col("n_class").cast("double"))).alias("balanced_weight"),
                    (neg.cast("double") / F.greatest(pos, F.lit(1)).cast("double")).alias("pos_weight"))


def with_weights(train: DataFrame, label: str = "is_churned", mode: str = "balanced",
                 out: str = "weight") -> DataFrame:
    """Attach a per-row weight column (``balanced`` or ``pos``) for Spark ML
    ``weightCol``; the class table is two rows, broadcast."""
    w = class_weights(train, label)
    col = "balanced_weight" if mode == "balanced" else "pos_weight"
    j = train.join(F.broadcast(w.select(F.col("label").alias("_l"), col, "n_class")),
                   F.col(label).cast("int") == F.col("_l"))
    if mode == "balanced":
        return j.withColumn(out, F.col(col)).drop("_l", col, "n_class")
    return j.withColumn(out, F.when(F.col("_l") == 1, F.col(col)).otherwise(1.0)).drop(
        "_l", col, "n_class")


#: Columns that tell where a synthetic row comes from (null for customers).
PARENTS = [("parent", "bigint"), ("neighbour", "bigint"), ("copy", "int"), ("gap", "double")]


def smote_oversample(train: DataFrame, features: list[str], label: str = "is_churned",
                     ratio: float = 0.5, k: int = 5, seed: int = DEFAULT.seed) -> DataFrame:
    """M6: synthetic minority rows until minority = ``ratio`` · majority.

    Each synthetic row moves a minority row towards one of its ``k`` nearest
    minority rows (exact, ``operators.neighbours``) by a hash-seeded gap in
    [0, 1). Exactly the missing number of rows is produced (distributed rank, no
    global limit). If the minority already reaches ``ratio`` nothing is added.
    Input features should be scaled.
    """
    counts = train.groupBy(label).count().collect()  # one row per class
    n = {int(r[label]): int(r["count"]) for r in counts}
    orig = train.select(C, F.col(label).cast("int").alias(label), *features, F.lit(False).alias("synthetic"),
                        *[F.lit(None).cast(t).alias(c) for c, t in PARENTS])
    if len(n) < 2:
        return orig
    minority = min(n, key=lambda c: (n[c], c))
    majority = max(n, key=lambda c: (n[c], -c))
    need = int(ratio * n[majority]) - n[minority]
    if need <= 0 or n[minority] < 2:
        return orig
    mino = (train.filter(F.col(label) == minority)
            .select(C, F.array(*[F.col(f).cast("double") for f in features]).alias("v")))
    near = nearest(mino.withColumnRenamed(C, "a"), k)
    va = mino.select(F.col(C).alias("a"), F.col("v").alias("va"))
    vb = mino.select(F.col(C).alias("b"), F.col("v").alias("vb"))
    nn = near.join(va, "a").join(vb, "b")
    deg = nn.groupBy("a").agg(F.max("j").alias("deg"))
    per_row = -(-need // n[minority])
    base = deg.select("a", "deg", F.explode(F.sequence(F.lit(1), F.lit(per_row))).alias("rep"))
    u = F.xxhash64(F.lit(seed), F.col("a"), F.col("rep"))
    gap = (F.pmod(F.xxhash64(F.lit(seed + 1), F.col("a"), F.col("rep")), F.lit(1_000_000))
           .cast("double") / 1e6)
    picks = base.select("a", "rep", (F.pmod(u, F.col("deg")) + 1).alias("j"),
                        gap.alias("gap"), u.alias("_o"))
    chosen = global_rank(picks, [F.col("_o"), F.col("a"), F.col("rep")], "_rk").filter(
        F.col("_rk") <= need)
    syn = (chosen.join(nn.select("a", "j", "b", "va", "vb"), ["a", "j"])
           .select("a", "b", "rep", "gap", F.zip_with("va", "vb", lambda x, y: x + (y - x) * F.col("gap"))
                   .alias("vs")))
    # a synthetic row is no customer: it has no key, but names its parents
    syn_rows = syn.select(
        F.lit(None).cast(train.schema[C].dataType).alias(C), F.lit(minority).cast("int").alias(label),
        *[F.col("vs")[i].alias(f) for i, f in enumerate(features)], F.lit(True).alias("synthetic"),
        F.col("a").cast("bigint").alias("parent"), F.col("b").cast("bigint").alias("neighbour"),
        F.col("rep").cast("int").alias("copy"), F.col("gap").alias("gap"))
    return orig.unionByName(syn_rows)
