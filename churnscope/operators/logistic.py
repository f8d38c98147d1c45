"""Logistic regression by Newton steps.

The objective is the original's: half the squared norm of the coefficients plus
C times the weighted log loss, where the intercept is penalised like a
coefficient (``penalise_intercept``, the original's dual-coordinate solver) or not
(its quasi-Newton solver). A step is one pass: every partition adds up its loss,
gradient and X'WX from rows kept as matrices, the partial sums are added, and the
driver solves a system of (features + 1) unknowns by Cholesky. What reaches the driver is
(features + 1)(features + 2) + 1 numbers, however many rows or partitions.

An empty table gives coefficients of zero. Rows of one class only, without a
penalty on the intercept, have no optimum: the steps end at ``passes``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Optimum:
    coefficients: list[float]
    intercept: float
    gradient_norm: float
    passes: int


def _blocks(data: DataFrame, features: list[str], label: str, weight: str | None) -> RDD:
    """The rows as matrices of features, 1, label and weight, kept in memory or on
    disk, so that a step doesn't read and convert the table again. A lost one is
    made anew from ``data``."""
    width = len(features) + 3

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.empty((b.num_rows, width))
            for i, c in enumerate(b.columns):
                x[:, i] = c.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["x"])

    columns = [*map(F.col, features), F.lit(1), F.col(label), F.col(weight) if weight else F.lit(1)]
    rows = data.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(packed, "x binary")
    return rows.rdd.map(lambda r: np.frombuffer(bytes(r[0])).reshape(-1, width)).persist(StorageLevel.MEMORY_AND_DISK)


def _sums(blocks: RDD, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted log loss, its gradient and X'WX at ``theta``; the intercept is last."""
    width = len(theta)

    def partial(part: int, some: Iterator[np.ndarray]) -> Iterator[tuple[int, tuple]]:
        loss, grad, hess = 0.0, np.zeros(width), np.zeros((width, width))
        for b in some:
            x, y, w = b[:, :width], b[:, width], b[:, width + 1]
            z = x @ theta
            p = np.where(z >= 0, 1.0, np.exp(-np.abs(z))) / (1.0 + np.exp(-np.abs(z)))
            loss += float((w * (np.logaddexp(0.0, z) - y * z)).sum())
            grad += x.T @ (w * (p - y))
            hess += x.T @ (x * (w * p * (1.0 - p))[:, None])
        yield 0, (part, np.concatenate([[loss], grad, hess.ravel()]))

    def added(parts: Iterator[tuple[int, tuple]]) -> Iterator[np.ndarray]:
        # in the partitions' order: a float sum depends on it
        some = sorted((p for _, p in parts), key=lambda p: p[0])
        if some:
            yield sum(s for _, s in some)

    total = np.zeros(1 + width + width * width)
    for found in blocks.mapPartitionsWithIndex(partial).partitionBy(1, int).mapPartitions(added).collect():
        total = found
    return total[0], total[1:1 + width], total[1 + width:].reshape(width, width)


def fit(data: DataFrame, features: list[str], label: str, weight: str | None = None, c: float = 1.0,
        penalise_intercept: bool = False, tol: float = 1e-10, passes: int = 100) -> Optimum:
    """Fit on ``data`` (a written table; no nulls). The steps end where the norm
    of the gradient is at most ``tol`` times the sum of the weights (at least 1),
    or where halving a step no longer lowers the objective."""
    penalty = np.ones(len(features) + 1)
    penalty[-1] = float(penalise_intercept)
    total = data.agg(F.sum(weight if weight else F.lit(1.0))).first()[0] or 0.0
    blocks = _blocks(data, features, label, weight)

    def at(theta: np.ndarray):
        loss, grad, hess = _sums(blocks, theta)
        return 0.5 * float(penalty @ (theta * theta)) + c * loss, penalty * theta + c * grad, np.diag(penalty) + c * hess

    theta, n = np.zeros(len(features) + 1), 1
    value, grad, hess = at(theta)
    while n < passes and np.linalg.norm(grad) > tol * max(1.0, total):
        # the smallest ridge that keeps the factor finite where p is 0 or 1 everywhere
        low = np.linalg.cholesky(hess + np.eye(len(theta)) * 1e-14 * max(1.0, np.trace(hess)))
        step = np.linalg.solve(low.T, np.linalg.solve(low, grad))
        scale, better = 1.0, None
        while better is None and n < passes and scale > 1e-9:
            tried, n = at(theta - scale * step), n + 1
            # near the optimum the objective is flat to the last digit: the gradient decides
            if tried[0] <= value - 1e-4 * scale * float(grad @ step) or np.linalg.norm(tried[1]) < 0.5 * np.linalg.norm(grad):
                better = tried
            else:
                scale /= 2
        if better is None:
            break
        theta, (value, grad, hess) = theta - scale * step, better
    blocks.unpersist()
    return Optimum(theta[:-1].tolist(), float(theta[-1]), float(np.linalg.norm(grad)), n)


def stage(spark, found: Optimum) -> LogisticRegressionModel:
    """The optimum as Spark ML's model, which scores, saves and loads itself."""
    of_jvm = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    vector = _py2java(spark.sparkContext, Vectors.dense(found.coefficients))
    return LogisticRegressionModel(of_jvm("logistic-newton", vector, found.intercept))
