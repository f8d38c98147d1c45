"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample (SAMPLE rows, the first by a hash of the
id); every row is indexed, that is, sent down to its leaf. A query visits
leaves best bin first: a priority queue holds the tree's open branches by an
upper estimate of the inner product (query and centre, plus the query's norm
times the branch's radius), and its best branch is opened next until
the wanted number of leaves is reached and they hold more than ``k`` rows. That
number is calibrated: for
CALIBRATION queries the exact neighbours are found by brute force over all
rows, in blocks, and the visits are widened until the share of them that lie
in visited leaves reaches TARGET.

Neighbouring leaves form groups of about BLOCK rows; a leaf with more is a group
of several blocks, dealt by a hash of the id, and its queries go to all of them,
so a vector that a third of all rows share is spread over tasks. A query goes to
a group once, with the leaves it visits there; each block answers with its best
``k`` a query, and the best of those are the result. Scores are inner products
of the original vectors in double precision, summed component by component in
one fixed way, so equal vectors have equal scores; ties go to the smaller id.

Defined results: vectors that are null, empty or zero, hold null or non-finite
components, or have another length than most take no part, as query or
candidate; nor do rows without an id. Rows that repeat an id are one row. With
fewer than ``k`` candidates all are returned (the visits cover every leaf of a
small table). An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnscope.llm.common import hash_sample, written

K = 20
SAMPLE = 30_000
BRANCHES = 8
LEAF = 48
CALIBRATION = 200
TARGET = 0.94
BLOCK = 4096
RADIUS_WEIGHT = 1.0


@dataclass
class Tree:
    """Centres and radii by node; children are node numbers, leaves have none.
    ``leaf`` is a node's leaf number or -1."""
    centre: list[np.ndarray] = field(default_factory=list)
    radius: list[float] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    n_leaves: int = 0

    def freeze(self) -> None:
        self.block = [np.stack([self.centre[c] for c in ch]) if ch else None for ch in self.children]
        self.reach = [np.array([self.radius[c] for c in ch]) if ch else None for ch in self.children]
        self.half = [0.5 * (b ** 2).sum(axis=1) if b is not None else None for b in self.block]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: at every node the nearest child centre."""
        out, open_nodes = np.empty(len(x), np.int64), [(0, np.arange(len(x)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = (x[rows] @ self.block[node].T - self.half[node]).argmax(axis=1)
            open_nodes += [(c, rows[near == i]) for i, c in enumerate(self.children[node]) if (near == i).any()]
        return out

    def best_bins(self, q: np.ndarray, visits: int, counts: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``visits`` leaves, best bin first, and more until they hold
        ``least`` rows by ``counts``, the rows of each leaf."""
        queue, out, weight, held = [(0.0, 0)], [], RADIUS_WEIGHT * float(np.sqrt(q @ q)), 0
        while queue and (len(out) < visits or held < least):
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                out.append(self.leaf[node])
                held += 0 if counts is None else int(counts[out[-1]])
                continue
            bound = self.block[node] @ q + weight * self.reach[node]
            for b, c in zip(bound.tolist(), self.children[node]):
                heapq.heappush(queue, (-b, c))
        return out


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Cluster numbers of the rows; equal rows always share a cluster."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ centres.T - 0.5 * (centres ** 2).sum(axis=1)).argmax(axis=1)
        centres = np.stack([x[near == i].mean(axis=0) if (near == i).any() else centres[i] for i in range(k)])
    return (x @ centres.T - 0.5 * (centres ** 2).sum(axis=1)).argmax(axis=1)


def fit(x: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 7) -> Tree:
    """Split until a node has at most ``leaf`` rows or can't be split."""
    tree, rng = Tree(), np.random.default_rng(seed)

    def grow(rows: np.ndarray) -> int:
        node, c = len(tree.centre), rows.mean(axis=0)
        tree.centre.append(c)
        tree.radius.append(float(np.sqrt(((rows - c) ** 2).sum(axis=1).max())))
        tree.children.append([])
        tree.leaf.append(-1)
        parts = []
        if len(rows) > leaf and tree.radius[node] > 1e-9:
            near = k_means(rows, min(branches, len(rows)), rng)
            parts = [rows[near == i] for i in np.unique(near)]
        if len(parts) < 2:
            tree.leaf[node] = tree.n_leaves
            tree.n_leaves += 1
        else:
            tree.children[node] = [grow(p) for p in parts]
        return node

    grow(x if len(x) else np.zeros((1, 1)))
    tree.freeze()
    return tree


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of one vector with rows: products are added component by
    component, so a row's result doesn't depend on the rows beside it."""
    out = np.zeros(len(x))
    for i in range(x.shape[1]):
        out += q[i] * x[:, i]
    return out


def best_of_block(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray, k: int,
                  seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of each query's best k rows of a block but
    itself, ties to the smaller id; ``seen`` says which rows a query looks at.
    A matrix product picks the rows that could be among them, with a margin for
    its rounding; ``inner`` scores those."""
    ids, found, scores = [], [], []
    size = np.sqrt((x ** 2).sum(axis=1)).max()
    for at in range(0, len(q), 256):
        rough = q[at:at + 256] @ x.T
        if seen is not None:
            rough[~seen[at:at + 256]] = -np.inf
        if len(vid) > k + 1:
            floor = np.partition(rough, len(vid) - k - 1, axis=1)[:, len(vid) - k - 1]
        else:
            floor = np.full(len(rough), -np.inf)
        for i, (r, f) in enumerate(zip(rough, floor)):
            one = at + i
            near = np.flatnonzero(r >= f - 1e-9 * (1.0 + size * np.abs(q[one]).sum()))
            near = near[(vid[near] != qid[one]) & (r[near] > -np.inf)]
            s = inner(q[one], x[near])
            best = np.lexsort((vid[near], -s))[:k]
            ids.append(np.full(len(best), qid[one]))
            found.append(vid[near[best]])
            scores.append(s[best])
    z = np.zeros(0)
    return tuple(np.concatenate(v) if v else z for v in (ids, found, scores))


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part: one per id, v in doubles."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        "vec_id is not null and v is not null and size(v) > 0")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda c: c != 0)).groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows


def _stack(column: pd.Series, d: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, d))


def search(vectors: DataFrame, k: int = K, every: int = 20, sample: int = SAMPLE, target: float = TARGET,
           calibration: int = CALIBRATION, block: int = BLOCK, visits: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose
    vec_id is divisible by ``every``. ``visits`` fixes the leaves a query visits
    instead of calibrating it."""
    schema = "query_id long, rank int, vec_id long, score double"
    rows = written(valid(vectors), "vectors")
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    d = lengths["d"]
    rows = rows.where(F.size("v") == d)
    tree = fit(np.array([r.v for r in hash_sample(rows, sample, "vec_id").collect()]))

    def to_leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(leaf=tree.leaf_of(_stack(b["v"], d)))

    placed = written(rows.mapInPandas(to_leaf, "vec_id long, v array<double>, leaf long"), "leaves")
    # bounded by the leaves, hence by the sample
    counts = np.zeros(tree.n_leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():
        counts[r["leaf"]] = r["count"]
    group, blocks = group_leaves(counts, block)
    deal = F.broadcast(vectors.sparkSession.createDataFrame(
        [(leaf, int(g), int(blocks[g])) for leaf, g in enumerate(group)], "leaf long, part long, blocks long"))
    index = placed.join(deal, "leaf").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("blocks"))).drop("blocks")
    queries = rows.where(F.col("vec_id") % every == 0)

    if visits is None:
        visits = calibrate(tree, hash_sample(queries, calibration, "vec_id"), placed, k, target)

    def to_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, v in zip(b["vec_id"], b["v"]):
                leaves = np.array(tree.best_bins(np.asarray(v, np.float64), visits, counts, k + 1))
                out += [(i, v, int(g), leaves[group[leaves] == g]) for g in np.unique(group[leaves])]
            yield pd.DataFrame(out, columns=["query_id", "q", "part", "leaves"])

    sizes = deal.select("part", "blocks").distinct()
    asked = queries.mapInPandas(to_parts, "query_id long, q array<double>, part long, leaves array<long>")
    asked = asked.join(F.broadcast(sizes), "part").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        names, leaf = np.unique(right["leaf"].to_numpy(), return_inverse=True)
        seen = np.stack([np.isin(names, v) for v in left["leaves"]])[:, leaf]
        qid, vid, s = best_of_block(left["query_id"].to_numpy(), _stack(left["q"], d), right["vec_id"].to_numpy(),
                                    _stack(right["v"], d), k, seen)
        return pd.DataFrame({"query_id": qid.astype(np.int64), "vec_id": vid.astype(np.int64), "score": s})

    met = asked.groupBy("part", "block").cogroup(index.groupBy("part", "block")).applyInPandas(
        answer, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def group_leaves(counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Group of each leaf, and blocks of each group: neighbouring leaves share a
    group up to ``block`` rows; a larger leaf has a group of its own."""
    group, blocks, held = np.zeros(len(counts), np.int64), [0], 0
    for leaf, n in enumerate(counts.tolist()):
        if held and held + n > block:
            blocks.append(0)
            held = 0
        held += n
        group[leaf] = len(blocks) - 1
        blocks[-1] = max(1, -(-held // block))
    return group, np.array(blocks)


def calibrate(tree: Tree, some: DataFrame, placed: DataFrame, k: int, target: float) -> int:
    """Leaves to visit so that the given bounded set of queries finds at least
    ``target`` of its exact neighbours, which brute force over all rows gives."""
    got = [(r.vec_id, r.v) for r in some.collect()]
    if not got:
        return tree.n_leaves
    qid, q = np.array([g[0] for g in got]), np.array([g[1] for g in got])

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                ids, vid, s = best_of_block(qid, q, b["vec_id"].to_numpy(), _stack(b["v"], q.shape[1]), k)
                leaf = dict(zip(b["vec_id"], b["leaf"]))
                yield pd.DataFrame({"query_id": ids.astype(np.int64), "vec_id": vid.astype(np.int64), "score": s,
                                    "leaf": [leaf[v] for v in vid]})

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = (placed.mapInPandas(exact, "query_id long, vec_id long, score double, leaf long")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "leaf").collect())
    at = {int(i): {leaf: n for n, leaf in enumerate(tree.best_bins(v, tree.n_leaves))} for i, v in zip(qid, q)}
    places = np.sort([at[r.query_id][r.leaf] for r in true])
    if not len(places):
        return tree.n_leaves
    return int(places[min(len(places) - 1, int(np.ceil(target * len(places))) - 1)]) + 1
