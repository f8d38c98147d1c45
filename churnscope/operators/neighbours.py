"""Exact k nearest neighbours by pivots (for M6), without comparing all pairs.

Equal vectors are one point that keeps its k + 1 smallest ids, because no row has
more than k neighbours in it; a vector that many rows share is thus looked at
once. Points are dealt to the nearest of a bounded number of pivots, and large
cells into blocks. A point first searches its own block, which bounds the
distance of its k-th neighbour; then it visits those cells only that the triangle
inequality doesn't exclude: the distance to the pivot less the cell's radius, or
the cell's inner radius less that distance, is a lower bound for the whole cell.

Distances are Euclidean, squares added feature by feature in order, so that a pair
has one distance wherever it is computed; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnscope.operators.ranking import materialize

PIVOTS = 256
BLOCK = 2048
SLICE = 64


def squared_distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(q), len(x)))
    for f in range(x.shape[1]):
        d = q[:, f, None] - x[None, :, f]
        out += d * d
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _within(d: np.ndarray, size: np.ndarray, own: np.ndarray, k: int) -> float:
    """A distance within which there are k rows besides the point's own: ``size``
    ids by point, one of them the point's."""
    order = np.argsort(d, kind="stable")
    held = np.cumsum(size[order] - own[order])
    at = np.searchsorted(held, k)
    return float(d[order[at]]) if at < len(order) else np.inf


def nearest(rows: DataFrame, k: int, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(a, j, b, d) for the ``rows`` (a: id, v: array of doubles, all of one length):
    the j-th nearest other row b of every row a, at squared distance d; fewer
    than k if there are fewer rows. Ids are unique."""
    spark, schema = rows.sparkSession, "a long, j int, b long, d double"
    by_id = Window.partitionBy("v").orderBy("a")
    few = rows.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
    points = materialize(few.groupBy("v").agg(F.sort_array(F.collect_list("a")).alias("ids")).withColumn(
        "p", F.element_at("ids", 1)), "points")
    n = points.count()
    if n == 0:
        return spark.createDataFrame([], schema)
    # bounded by ``pivots``
    centre = np.array([r["v"] for r in points.orderBy(F.xxhash64("p"), "p").limit(min(pivots, max(1, int(n ** 0.5)))).collect()], np.float64)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                d = squared_distances(_matrix(b["v"]), centre)
                yield b.assign(cell=d.argmin(axis=1), r=np.sqrt(d.min(axis=1)))

    cells = materialize(points.mapInPandas(placed, "v array<double>, ids array<long>, p long, cell long, r double"), "cells")
    # one row a pivot
    size = {r["cell"]: r for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi")).collect()}
    low, high = (np.array([size[c][f] if c in size else bad for c in range(len(centre))]) for f, bad in (("lo", np.inf), ("hi", -np.inf)))
    parts = np.array([-(-size[c]["n"] // block) if c in size else 0 for c in range(len(centre))])
    of = F.element_at(F.array(*[F.lit(int(c)) for c in parts]), (F.col("cell") + 1).cast("int"))
    index = cells.withColumn("part", F.pmod(F.xxhash64("p"), of)).select("cell", "part", "p", "v", "ids")

    def home(some: pd.DataFrame) -> pd.DataFrame:
        x, count = _matrix(some["v"]), some["ids"].map(len).to_numpy()
        far = np.full(len(some), np.inf)
        for at in range(0, len(some), SLICE):
            for i, d in enumerate(squared_distances(x[at:at + SLICE], x)):
                far[at + i] = _within(d, count, np.arange(len(some)) == at + i, k)
        return pd.DataFrame({"p": some["p"], "v": some["v"], "far": far})

    bounded = index.groupBy("cell", "part").applyInPandas(home, "p long, v array<double>, far double")

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            if len(b):
                d = np.sqrt(squared_distances(_matrix(b["v"]), centre))
                reach = np.sqrt(b["far"].to_numpy())[:, None]
                least = np.maximum(d - high, low - d)
                i, c = np.nonzero((least <= reach + 1e-9 * (1 + d)) & (parts > 0))
                again = np.repeat(np.arange(len(i)), parts[c])
                part = np.concatenate([np.arange(parts[j]) for j in c]) if len(c) else np.zeros(0, np.int64)
                i, c = i[again], c[again]
                yield pd.DataFrame({"p": b["p"].to_numpy()[i], "v": b["v"].to_numpy()[i], "far": b["far"].to_numpy()[i], "cell": c, "part": part})

    asked = bounded.mapInPandas(visits, "p long, v array<double>, far double, cell long, part long")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            q, x, far = _matrix(left["v"]), _matrix(right["v"]), left["far"].to_numpy()
            ids, held = right["ids"].tolist(), right["ids"].map(len).to_numpy()
            for at in range(0, len(q), SLICE):
                for i, d in enumerate(squared_distances(q[at:at + SLICE], x)):
                    # the first k + 1 rows: all points up to the distance at which the block holds them
                    on = np.flatnonzero(d <= min(far[at + i], _within(d, held, np.zeros(len(d), int), k + 1)))
                    found = sorted((d[j], b) for j in on for b in ids[j])[:k + 1]
                    out += [(int(left["p"].iloc[at + i]), b, s) for s, b in found]
        return pd.DataFrame(out, columns=["p", "b", "d"]).astype({"p": "int64", "b": "int64", "d": "float64"})

    met = asked.groupBy("cell", "part").cogroup(index.groupBy("cell", "part")).applyInPandas(meet, "p long, b long, d double")
    order = Window.partitionBy("p").orderBy("d", "b")
    first = materialize(met.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).select("p", "b", "d"), "neighbours")
    # every row takes its point's list but itself
    of_row = rows.select("a", "v").join(points.select("v", "p"), "v").select("a", "p")
    each = of_row.join(first, "p").where("a != b")
    mine = Window.partitionBy("a").orderBy("d", "b")
    return each.withColumn("j", F.row_number().over(mine)).where(F.col("j") <= k).select("a", "j", "b", "d")
