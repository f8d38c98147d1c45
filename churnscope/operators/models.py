"""Models and ensembles.

Logistic regression is that of ``operators.logistic`` (Newton steps); forests and
boosted trees are those of ``operators.trees``, which fit several models, and the
folds of a cross-validation, in shared passes. What is written here is the protocol
around them — scaling, class weights, the train loop and its result table, the
top-3 soft vote, stratified k-fold AUC, scoring all customers and feature
importances — all as DataFrame jobs (metrics use the distributed evaluation of
``operators.metrics``).
"""

from __future__ import annotations

from contextvars import copy_context
from dataclasses import dataclass, field, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnscope.config import DEFAULT
from churnscope.operators import logistic
from churnscope.operators import metrics as mt
from churnscope.operators import ml_prep as mp
from churnscope.operators import trees
from churnscope.operators.ranking import materialize

C = "CustomerID"
LABEL = "is_churned"
PROB = "churn_probability"


@dataclass(frozen=True)
class ModelSpec:
    name: str
    kind: str                      # lr (operators.logistic) | rf | gbt (Spark ML) | boost | forest (operators.trees)
    params: dict = field(default_factory=dict)
    weight: str | None = None      # balanced | pos | None
    scaled: bool = False           # fit on standardised features
    smote: bool = False            # fit on SMOTE-balanced scaled rows (if minority < 40 %)


# The model line-ups of the two modelling steps with the original's
# parameters; what it leaves to its libraries' defaults (regularisation, least
# Hessian, start at the mean) is stated here. ``gbt_pos_weighted`` is second-order
# boosting by level with a weight on positives, ``gbt_balanced`` leaf-wise boosting.
# Logistic regression has C = 1; the integrated step's solver penalises the
# intercept too, the time-series step's doesn't.
FRIEDMAN = {"trees": 100, "rate": 0.1, "depth": 5, "gain": "friedman", "l2": 0.0, "least_hessian": 0.0, "least_split": 20, "from_mean": True}
NEWTON = {"trees": 200, "rate": 0.1, "depth": 6, "l2": 1.0, "least_hessian": 1.0}
LEAF_WISE = {"trees": 200, "rate": 0.1, "depth": 6, "leaves": 31, "l2": 0.0, "least_hessian": 1e-3, "least_rows": 20, "from_mean": True}
TS_SPECS = [
    ModelSpec("Logistic Regression", "lr", {"c": 1.0, "penalise_intercept": False}, "balanced",
              scaled=True),
    ModelSpec("Random Forest", "forest", {"trees": 100, "depth": 10, "least_split": 20, "least_rows": 10}, "balanced"),
    ModelSpec("Gradient Boosting", "boost", FRIEDMAN),
]
CH_SPECS = [
    ModelSpec("LogisticRegression", "lr", {"c": 1.0, "penalise_intercept": True}, "balanced",
              scaled=True, smote=True),
    ModelSpec("RandomForest", "forest", {"trees": 200, "depth": 10, "least_split": 20, "least_rows": 10}, "balanced"),
    ModelSpec("GradientBoosting", "boost", FRIEDMAN),
    ModelSpec("gbt_pos_weighted", "boost", NEWTON, "pos"),
    ModelSpec("gbt_balanced", "boost", LEAF_WISE, "balanced"),
]
TREE_KINDS = ("boost", "forest")


def _estimator(spec: ModelSpec, seed: int):
    common = {"featuresCol": "features", "labelCol": LABEL, "seed": seed} | ({"weightCol": "weight"} if spec.weight else {})
    return (RandomForestClassifier if spec.kind == "rf" else GBTClassifier)(**common, **spec.params)


def pos_weight(train: DataFrame) -> float:
    """M5: negatives per positive of the training rows."""
    r = train.agg(F.count_if(F.col(LABEL) == 0).alias("n"), F.count_if(F.col(LABEL) == 1).alias("p")).first()
    return r["n"] / max(r["p"], 1)


def scaler(train: DataFrame, features: list[str]) -> SQLTransformer:
    """M3 as a pipeline stage: (x - mean) / population std of the training
    rows (std 0 counts as 1), so that a saved model scores raw rows."""
    cols = []
    for r in mp.scaler_stats(train, features).collect():  # one row per feature
        std = r["std"] or 1.0
        cols.append(f"(CAST(`{r['feature']}` AS DOUBLE) - {r['mean'] or 0.0!r}D) / {std!r}D AS `{r['feature']}`")
    names = ", ".join(f"`{f}`" for f in features)
    return SQLTransformer(statement=f"SELECT * EXCEPT ({names}), {', '.join(cols)} FROM __THIS__")


def fit(spec: ModelSpec, train: DataFrame, features: list[str], seed: int = DEFAULT.seed,
        weight_of_positives: float | None = None) -> PipelineModel:
    """Fit one spec. ``train`` must already be scaled if ``spec.scaled``.
    ``weight_of_positives`` replaces the rate of ``train`` in the ``pos``
    weighting (folds keep the weight of the whole training set)."""
    data = train.select(C, LABEL, *features)
    if spec.weight == "pos" and weight_of_positives is not None:
        data = data.withColumn("weight", F.when(F.col(LABEL) == 1, F.lit(float(weight_of_positives))).otherwise(F.lit(1.0)))
    elif spec.weight:
        data = mp.with_weights(data, LABEL, spec.weight, "weight")
    # written once: iterative learners then read the materialised rows
    data = materialize(data, "training")
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    if spec.kind == "lr":
        found = logistic.fit(data, features, LABEL, "weight" if spec.weight else None, **spec.params)
        return PipelineModel(stages=[assembler, logistic.stage(data.sparkSession, found)])
    return Pipeline(stages=[assembler, _estimator(spec, seed)]).fit(data)


def task(spec: ModelSpec, counts: dict[tuple[int, int], int], seed: int, fold: int | None = None,
         weight_of_positives: float | None = None) -> trees.Task:
    """What ``operators.trees`` fits for a spec: with class weights from the
    counts, by (fold, class), of the rows that it trains on."""
    n = [sum(v for (f, c), v in counts.items() if c == y and (fold is None or f != fold)) for y in (0, 1)]
    weights = (1.0, 1.0)
    if spec.weight == "balanced":
        weights = tuple(sum(n) / (2.0 * max(v, 1)) for v in n)
    elif spec.weight == "pos":
        weights = (1.0, weight_of_positives if weight_of_positives is not None else n[0] / max(n[1], 1))
    return trees.Task((trees.Boost if spec.kind == "boost" else trees.Forest)(**spec.params), weights, fold, seed)


def fit_trees(specs: list[ModelSpec], train: DataFrame, features: list[str], seed: int = DEFAULT.seed, folds: int = 0,
              weight_of_positives: float | None = None) -> list[dict[int, trees.TreeModel]]:
    """Fit boosted and forest specs on ``train`` (a written table) in shared
    passes. Without ``folds`` each spec gives {0: model}; with them, {k: the
    model that has not seen the rows whose ``fold`` is k}."""
    fold = "fold" if folds else None
    counts = trees.class_counts(train, LABEL, fold)
    edges = trees.bin_edges(train, features)
    asked = [(i, k, task(s, counts, seed, k if folds else None, weight_of_positives)) for i, s in enumerate(specs) for k in range(folds or 1)]
    boosts, bags = ([a for a in asked if specs[a[0]].kind == kind] for kind in TREE_KINDS)
    data = trees.blocks(train, features, edges, LABEL, C, fold, 0)
    jobs = [lambda: trees.boost(data, [t for _, _, t in boosts], edges, counts, features) if boosts else [],
            lambda: trees.forest(data, [t for _, _, t in bags], edges, features) if bags else []]
    out: list[dict[int, trees.TreeModel]] = [{} for _ in specs]
    for some, models in zip((boosts, bags), parallel(lambda job: job(), jobs)):
        for (i, k, _), model in zip(some, models):
            out[i][k] = model
    data.unpersist()
    return out


def predict(model: PipelineModel | trees.TreeModel, df: DataFrame) -> DataFrame:
    """Adds ``churn_probability`` (class-1 probability) and
    ``predicted`` (the more probable class)."""
    if isinstance(model, trees.TreeModel):
        return df.withColumn(PROB, trees.probability_column(model)).withColumn("predicted", (F.col(PROB) > 0.5).cast("int"))
    out = model.transform(df)
    return (out.withColumn(PROB, vector_to_array("probability")[1])
            .withColumn("predicted", (F.col(PROB) > 0.5).cast("int"))
            .drop("features", "rawPrediction", "probability", "prediction"))


@dataclass
class Fitted:
    spec: ModelSpec
    model: PipelineModel | trees.TreeModel   # scores raw rows: a scaler is its first stage
    smoted: bool = False           # fitted on synthetic rows too


class Trainer:
    """Holds the split feature frame, fits specs and evaluates them."""

    def __init__(self, frame: DataFrame, features: list[str], seed: int = DEFAULT.seed,
                 fractions: tuple[float, float, float] = DEFAULT.split_fractions):
        self.features = features
        self.seed = seed
        # only the label and the key go through the rank of the split
        split = mp.stratified_split(frame.select(C, LABEL), LABEL, seed=seed, **mp.split_sizes(fractions))
        self.frame = materialize(frame.join(split.select(C, "split"), C), "frame")
        self.train = self.frame.filter(F.col("split") == "train")
        self.val = self.frame.filter(F.col("split") == "val")
        self.test = self.frame.filter(F.col("split") == "test")
        self.scaler = scaler(self.train, features)

    def fit_all(self, specs: list[ModelSpec]) -> list[Fitted]:
        """Fit the specs side by side; trees share their passes."""
        of_trees = [s for s in specs if s.kind in TREE_KINDS]
        jobs = [lambda: [Fitted(s, m[0]) for s, m in zip(of_trees, fit_trees(of_trees, self.train, self.features, self.seed))] if of_trees else [],
                *[lambda s=s: [self.fit(s)] for s in specs if s.kind not in TREE_KINDS]]
        by_name = {f.spec.name: f for found in parallel(lambda job: job(), jobs) for f in found}
        return [by_name[s.name] for s in specs]

    def fit(self, spec: ModelSpec) -> Fitted:
        if spec.kind in TREE_KINDS:
            return self.fit_all([spec])[0]
        train, smoted = self.scaler.transform(self.train) if spec.scaled else self.train, False
        if spec.smote:
            rate = self.train.agg(F.avg(LABEL)).first()[0]
            if rate < 0.4:
                train, smoted = mp.smote_oversample(train, self.features, LABEL, 0.5, 5, self.seed), True
        model = fit(spec, train, self.features, self.seed)
        if spec.scaled:
            model = PipelineModel(stages=[self.scaler, *model.stages])
        return Fitted(spec, model, smoted)

    def voter(self, fitted: Fitted) -> Fitted:
        """The member that votes: a model fitted on synthetic rows is fitted
        anew on the training rows alone."""
        return self.fit(replace(fitted.spec, smote=False)) if fitted.smoted else fitted

    def score_all(self, fitted: Fitted) -> DataFrame:
        """Key, label, split, probability and class of every customer,
        scored and written once; every metric and output reads it."""
        scored = predict(fitted.model, self.frame).select(C, LABEL, "split", PROB, "predicted")
        return materialize(scored, "scores")


def parallel(fn, items, threads: int = 4):
    """Run independent fits concurrently from driver threads (Spark
    schedules their jobs side by side, like ``CrossValidator.parallelism``)."""
    from concurrent.futures import ThreadPoolExecutor
    items = list(items)
    if threads <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(threads, len(items))) as pool:
        # each job keeps the caller's context (the run's folder)
        return [f.result() for f in [pool.submit(copy_context().run, fn, x) for x in items]]


def evaluate(scored: DataFrame) -> dict:
    """AUC, precision, recall, F1 of one scored split (a handful of numbers)."""
    a = mt.auc(scored, LABEL, PROB).first()[0]
    m = mt.classification_metrics(scored, LABEL, pred="predicted").first()
    return {"auc": a, "precision": m["precision"], "recall": m["recall"], "f1": m["f1"],
            "accuracy": m["accuracy"]}


def part(scored: DataFrame, split: str) -> DataFrame:
    return scored.filter(F.col("split") == split)


def soft_vote(scored: list[DataFrame]) -> DataFrame:
    """Mean class-1 probability of the members, joined on the key."""
    keep = [c for c in (C, LABEL, "split", "fold") if c in scored[0].columns]
    out = scored[0].select(*keep, F.col(PROB).alias("p0"))
    for i, s in enumerate(scored[1:], 1):
        out = out.join(s.select(C, F.col(PROB).alias(f"p{i}")), C)
    mean = sum(F.col(f"p{i}") for i in range(len(scored))) / float(len(scored))
    return (out.withColumn(PROB, mean).withColumn("predicted", (F.col(PROB) > 0.5).cast("int"))
            .drop(*[f"p{i}" for i in range(len(scored))]))


def importances(fitted: Fitted, features: list[str]) -> list[tuple[str, float, float | None]]:
    """(feature, importance, coefficient), largest importance first; the
    importance of a logistic regression is |coefficient|, trees have none."""
    if isinstance(fitted.model, trees.TreeModel):
        rows = [(f, float(v), None) for f, v in zip(features, fitted.model.importance)]
        return sorted(rows, key=lambda t: (-t[1], features.index(t[0])))
    est = fitted.model.stages[-1]
    if hasattr(est, "featureImportances"):
        rows = [(f, float(v), None) for f, v in zip(features, est.featureImportances.toArray().tolist())]
    else:
        rows = [(f, abs(float(v)), float(v)) for f, v in zip(features, est.coefficients.toArray().tolist())]
    return sorted(rows, key=lambda t: (-t[1], features.index(t[0])))


def folds_of(frame: DataFrame, folds: int, seed: int = DEFAULT.seed) -> DataFrame:
    """(CustomerID, fold): rank inside the class (seeded MD5 order, distributed
    rank over key and label only) modulo ``folds``."""
    from churnscope.operators.ranking import global_rank
    keyed = frame.select(C, LABEL).withColumn("_k", mp.split_key(seed + 1))
    ranked = global_rank(keyed, [F.col(LABEL), F.col("_k"), F.col(C)], "_rk")
    counts = frame.groupBy(LABEL).agg(F.count(F.lit(1)).alias("_nc"))
    before = Window.orderBy(LABEL).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(LABEL, F.coalesce(F.sum("_nc").over(before), F.lit(0)).alias("_off"))
    return ranked.join(F.broadcast(offs), LABEL).select(
        C, F.pmod(F.col("_rk") - F.col("_off") - 1, F.lit(folds)).cast("int").alias("fold"))


def cross_validate(frame: DataFrame, specs, features: list[str], folds: int = 5,
                   seed: int = DEFAULT.seed, threads: int = 5,
                   weight_of_positives: float | None = None) -> list[float]:
    """Stratified k-fold AUC on all rows, for one spec or a soft-vote
    ensemble of several (members refit on each fold, probabilities averaged).
    Trees of all folds grow in shared passes over one table; other members are
    fitted fold by fold, concurrently."""
    specs = [specs] if isinstance(specs, ModelSpec) else list(specs)
    folded = materialize(frame.join(folds_of(frame, folds, seed), C), "folds")
    of_trees = [s for s in specs if s.kind in TREE_KINDS]
    others = [(s, k) for s in specs if s.kind not in TREE_KINDS for k in range(folds)]

    def one(job) -> DataFrame:
        spec, k = job
        x, y = folded.filter(F.col("fold") != k), folded.filter(F.col("fold") == k)
        if spec.scaled:
            stage = scaler(x, features)
            x, y = stage.transform(x), stage.transform(y)
        model = fit(spec, x, features, seed, weight_of_positives)
        return predict(model, y).select(C, LABEL, "fold", PROB)

    jobs = [lambda: fit_trees(of_trees, folded, features, seed, folds, weight_of_positives) if of_trees else [],
            *[lambda j=j: one(j) for j in others]]
    by_fold, *parts = parallel(lambda job: job(), jobs, threads)
    scored = [folded.select(C, LABEL, "fold", trees.probability_column(m, "fold").alias(PROB)) for m in by_fold]
    for at in range(0, len(parts), folds):
        whole = parts[at]
        for p in parts[at + 1:at + folds]:
            whole = whole.unionByName(p)
        scored.append(whole)
    voted = materialize(scored[0] if len(scored) == 1 else soft_vote(scored), "fold-scores")
    return parallel(lambda k: mt.auc(voted.filter(F.col("fold") == k), LABEL, PROB).first()[0], range(folds), threads)
