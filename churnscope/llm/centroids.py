"""Centroid clustering with ns-bounds: exact k-means that skips distances.

Every row keeps, for each centroid, the last distance it had to it and the round
of that evaluation. The driver keeps the history of the centroids (rounds times
centroids, nothing that grows with the rows). In a later round a kept distance is
loosened by the norm of the centroid's total displacement since that round,
|c(now) - c(then)|, which never exceeds the sum of the drifts round by round: the
row's own distance grows by it at most, another's shrinks by it at most. A row
whose loosened own distance is below all others' stays without a distance being
computed. Otherwise its own distance is evaluated anew, and then only those
centroids whose loosened distance still doesn't exceed it are rescanned, exactly, in
integers; ties go to the smaller number. Bounds are compared with a margin for
the rounding of square roots, so the result is that of plain k-means.

A round is one pass over a written table (row, bounds, rounds, cluster), and one
over its rows and clusters that adds up the components inside each task, so that a
task hands over at most one row a cluster; sums are exact integers and the new
centroid is floor(sum / count).

Defined results: rows whose vector is null, has another length than ``length``
or a null or non-finite component are left out. A null id counts as the empty
string in the starting order; equal hashes go by the vector. Rows that repeat an
id are rows of their own. With fewer rows than ``k`` every row is a starting
centroid; equal centroids stay separate and the larger number stays empty.
Components of 2**27 or more after scaling raise, because squared distances would
not fit in 64 bits. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.llm.common import written

K = 16
ROUNDS = 3
LENGTH = 64
LARGEST = 1 << 27
STATE = "vec_id long, x array<int>, cluster int, kept array<double>, since array<int>, evaluated long"


def integers(vectors: DataFrame, scale: int = 64, length: int = LENGTH) -> DataFrame:
    """(vec_id, x) of the rows that are kept; x holds floor(scale * component)."""
    whole = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("double"))
    small = F.forall("v", lambda c: F.abs(c) < LARGEST)
    checked = F.when(small, F.col("v")).otherwise(F.raise_error(F.lit("a scaled component is 2**27 or more")).cast("array<double>"))
    rows = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") == length)).where(whole)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v")).select(
        "vec_id", checked.cast("array<int>").alias("x"))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to one point."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def moved(history: np.ndarray) -> np.ndarray:
    """[round then, centroid]: norm of the displacement from then to the last round."""
    return np.sqrt(((history - history[-1]) ** 2).sum(axis=2).astype(np.float64))


def assign(x: np.ndarray, cluster: np.ndarray, kept: np.ndarray, since: np.ndarray, history: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cluster, kept distances, their rounds, and the number of distances that
    each row evaluated, for the last centroids of ``history``. The arrays handed
    in are changed."""
    now, centres, shift = len(history) - 1, history[-1], moved(history)
    k, n = len(centres), len(x)
    each, row = np.arange(k), np.arange(n)
    used = np.zeros(n, np.int64)
    own = kept[row, cluster] + shift[since[row, cluster], cluster]
    least = kept - shift[since, each]
    least[row, cluster] = np.inf
    margin = 1e-9 * (1.0 + own)
    open_rows = np.flatnonzero((least <= (own + margin)[:, None]).any(axis=1))
    if not len(open_rows):
        return cluster, kept, since, used
    some, was, least = x[open_rows], cluster[open_rows], least[open_rows]
    exact = np.full((len(open_rows), k), np.iinfo(np.int64).max)
    at = np.arange(len(open_rows))
    exact[at, was] = ((some - centres[was]) ** 2).sum(axis=1)
    own = np.sqrt(exact[at, was].astype(np.float64))
    again = least <= (own + 1e-9 * (1.0 + own))[:, None]
    for j in range(k):
        hit = np.flatnonzero(again[:, j])
        exact[hit, j] = squared(some[hit], centres[j])
    again[at, was] = True
    i, j = np.nonzero(again)
    kept[open_rows[i], j] = np.sqrt(exact[i, j].astype(np.float64))
    since[open_rows[i], j] = now
    cluster[open_rows] = exact.argmin(axis=1)
    used[open_rows] = again.sum(axis=1)
    return cluster, kept, since, used


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """A writable matrix of an Arrow list column whose lists have one length."""
    return np.array(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), width)


def _lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel(), kind))


def _first(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """All distances of every row, kept as of round 0."""
    width = centres.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), width, np.int64)
            exact = np.stack([squared(x, c) for c in centres], axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("x"), pa.array(exact.argmin(axis=1), pa.int32()),
                 _lists(np.sqrt(exact.astype(np.float64)), pa.float64()), _lists(np.zeros(exact.shape, np.int32), pa.int32()),
                 pa.array(np.full(len(x), len(centres)), pa.int64())], ["vec_id", "x", "cluster", "kept", "since", "evaluated"])

    return rows.mapInArrow(scan, STATE)


def _next(state: DataFrame, history: np.ndarray) -> DataFrame:
    k, width = history.shape[1:]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster, kept, since, used = assign(
                _matrix(b.column("x"), width, np.int64), np.array(b.column("cluster").to_numpy(), np.int64),
                _matrix(b.column("kept"), k, np.float64), _matrix(b.column("since"), k, np.int32), history)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("x"), pa.array(cluster, pa.int32()), _lists(kept, pa.float64()), _lists(since, pa.int32()),
                 pa.array(used + b.column("evaluated").to_numpy(), pa.int64())], ["vec_id", "x", "cluster", "kept", "since", "evaluated"])

    return state.mapInArrow(scan, STATE)


def _centres(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """floor(sum / count) of every non-empty cluster, exact; others stay."""
    k, width = before.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for b in batches:
            x, cluster = _matrix(b.column("x"), width, np.int64), b.column("cluster").to_numpy()
            for j in np.unique(cluster):
                mine = cluster == j
                sums[j] += x[mine].sum(axis=0)
                counts[j] += mine.sum()
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64()), _lists(sums[some], pa.int64())],
                                         ["cluster", "n", "sums"])

    parts = state.select("x", "cluster").mapInArrow(partial, "cluster int, n long, sums array<long>")
    # one row a cluster and component: k * width rows come to the driver
    total = parts.select("cluster", "n", F.posexplode("sums").alias("i", "s")).groupBy("cluster", "i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out = before.copy()
    for r in total.collect():
        out[r["cluster"], r["i"]] = int(r["s"]) // r["n"]
    return out


def starting(rows: DataFrame, k: int = K, seed: str = "1:") -> np.ndarray:
    """The k rows with the smallest SHA-256 of seed and id, in ascending order."""
    h = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r["x"] for r in rows.withColumn("h", h).orderBy("h", "x").limit(k).collect()], np.int64)


def cluster(rows: DataFrame, k: int = K, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, x, cluster, kept, since, evaluated) of the rows (vec_id, x) after
    ``rounds`` rounds and a last assignment, and the history of the centroids.
    ``kept`` of a row's cluster may be of an earlier round; ``evaluated`` counts
    the distances that a row computed."""
    rows = written(rows, "centroid-rows")
    start = starting(rows, k)
    if not len(start):
        return rows.sparkSession.createDataFrame([], STATE), np.zeros((1, 0, 0), np.int64)
    history = start[None]
    state = written(_first(rows, start), "centroid-state")
    for _ in range(rounds):
        history = np.concatenate([history, _centres(state, history[-1])[None]])
        state = written(_next(state, history), "centroid-state")
    return state, history


def report(state: DataFrame, centres: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, with
    exact squared distances to the given centroids."""
    spark, width = state.sparkSession, centres.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, near = _matrix(b.column("x"), width, np.int64), b.column("cluster").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("cluster"), pa.array(((x - centres[near]) ** 2).sum(axis=1), pa.int64())],
                                             ["vec_id", "cluster", "distance"])

    rows = state.select("vec_id", "x", "cluster").mapInArrow(scan, "vec_id long, cluster int, distance long")
    # one row a centroid
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(sums.values())
    sides = [(j, s, total, hashlib.sha256(",".join(map(str, centres[j].tolist())).encode()).hexdigest()) for j, s in sums.items()]
    side = spark.createDataFrame(sides, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
