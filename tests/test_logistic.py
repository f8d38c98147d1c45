"""Newton steps of the logistic regression against plain NumPy."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from churnscope.operators import logistic
from churnscope.operators import ml_prep as mp
from churnscope.operators.features import TS_MODEL_FEATURES, model_frame
from churnscope.plans import steps as st
from churnscope.plans.catalog import ORACLE, QUERIES
from tests.conftest import SF_SMALL


def plain(x, y, w, c, penalise):
    """Newton steps with halving, all rows in memory."""
    x = np.column_stack([x, np.ones(len(x))])
    pen = np.ones(x.shape[1])
    pen[-1] = penalise
    theta = np.zeros(x.shape[1])

    def value(t):
        z = x @ t
        return 0.5 * pen @ (t * t) + c * (w * (np.logaddexp(0, z) - y * z)).sum()

    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ theta)))
        step = np.linalg.solve(np.diag(pen) + c * (x.T * (w * p * (1 - p))) @ x, pen * theta + c * x.T @ (w * (p - y)))
        scale = 1.0
        while value(theta - scale * step) > value(theta) and scale > 1e-6:
            scale /= 2
        theta = theta - scale * step
    return theta


@pytest.mark.parametrize("penalise", [True, False])
def test_coefficients_equal_plain_newton(spark, penalise):
    frame = model_frame(st.feature_table(spark, SF_SMALL, "ts"), "ts")
    scaled = mp.standardize(frame, mp.scaler_stats(frame, TS_MODEL_FEATURES), TS_MODEL_FEATURES)
    data = mp.with_weights(scaled.select("CustomerID", "is_churned", *TS_MODEL_FEATURES), "is_churned", "balanced", "weight")
    rows = data.toPandas()
    best = logistic.fit(data, TS_MODEL_FEATURES, "is_churned", "weight", 1.0, penalise)
    want = plain(rows[TS_MODEL_FEATURES].to_numpy(float), rows["is_churned"].to_numpy(float), rows["weight"].to_numpy(float), 1.0, penalise)
    assert best.gradient_norm < 1e-6
    assert np.allclose([*best.coefficients, best.intercept], want, atol=1e-6)


def test_optimum_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), int(a + rng.normal() > 0)) for a, b in rng.normal(size=(300, 2))]
    data = spark.createDataFrame(rows, "a double, b double, y int")
    one = logistic.fit(data.repartition(1), ["a", "b"], "y")
    many = logistic.fit(data.repartition(40, "a"), ["a", "b"], "y")
    assert np.allclose(one.coefficients, many.coefficients, atol=1e-9) and one.passes < 15
    scored = logistic.stage(spark, one).transform(spark.createDataFrame(
        [(r[2], Vectors.dense(r[:2])) for r in rows[:5]], ["y", "features"])).select("probability").collect()
    z = np.array([r[:2] for r in rows[:5]]) @ one.coefficients + one.intercept
    assert np.allclose([r[0][1] for r in scored], 1 / (1 + np.exp(-z)))


def test_steps_do_not_read_the_table_again(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rng = np.random.default_rng(5)
    rows = [(float(a), int(a + rng.normal() > 0)) for a in rng.normal(size=300)]
    best = logistic.fit(spark.createDataFrame(rows, "a double, y int").mapInPandas(counted, "a double, y int"), ["a"], "y")
    assert best.passes > 3
    assert seen.value <= 2 * 300     # the sum of the weights, then the rows


def test_empty_table_and_one_class(spark):
    none = spark.createDataFrame([], "a double, y int")
    assert logistic.fit(none, ["a"], "y").coefficients == [0.0]
    ones = spark.createDataFrame([(1.0, 1), (2.0, 1)], "a double, y int")
    kept = logistic.fit(ones, ["a"], "y", penalise_intercept=True)
    assert kept.gradient_norm < 1e-6 and np.isfinite(kept.intercept)
    assert np.isfinite(logistic.fit(ones, ["a"], "y", passes=20).intercept)


def test_gradient_query_equals_its_sql(spark, duck):
    got = sorted((r.feature, r.customers, r.gradient) for r in QUERIES["logistic_gradient_ts"](spark, SF_SMALL).collect())
    rel = duck.sql(ORACLE["logistic_gradient_ts"])
    assert got == sorted(rel.select("feature, customers, gradient").fetchall())
