"""Tree learners over histograms: second-order boosting, leaf-wise boosting,
first-order boosting and a random forest (E2-E5), with the folds of a
cross-validation as a dimension of the same passes (E9).

Training rows are cut into bins once (``bin_edges``, ``blocks``) and kept as
blocks of small integers, one or a few a partition. A pass is one Spark job: each
partition adds up the histograms (node, feature, bin) of the nodes that are
asked for and deals the nodes to reducers, which add the partial sums and find
each node's best split. Only the splits and the nodes' totals come to the driver, a
few numbers a node; how many nodes there are depends on the parameters.

* Boosting asks for both children of each split that may be split again. All
  boosters and folds advance together, so a pass serves them all. Rows carry the
  margin of the trees up to the last RENEW; the trees since then are applied
  inside the pass. A node of at most LOCAL_ROWS rows needs no further pass: its
  rows go to a reducer, which grows what is below it by the same steps and sends
  the splits back. Such a node's rows are fewer bytes than its subtree's histograms.
  Where the executors share a machine, boosting needs no job a pass: one stage grows
  all trees (``_side_by_side``), its tasks keep their rows and do the same steps.
* Leaf-wise growth keeps the open leaves in a priority queue by gain and splits the
  best until ``leaves`` is reached. Leaves that may still come to their turn are
  expanded in the same pass, so a tree takes about as many passes as it is deep;
  what the queue didn't reach is cut off again.
* The forest grows all trees (and folds) level by level. A row's Poisson bag
  weight is a hash of (seed, tree, key), a node's feature subset one of (seed,
  tree, node).

Nothing depends on how rows are dealt into partitions: bins come from a
mergeable sketch with exact counts, samples from hashes of the key, and
gradients are rounded to multiples of a power of two small enough for all sums to
be exact in doubles. Ties go to the first feature and the lowest cut. A null or NaN
feature goes to the right.
"""

from __future__ import annotations

import glob
import heapq
import math
import os
import pathlib
import pickle
import shutil
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial
from operator import add
from typing import NamedTuple
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, BarrierTaskContext, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BINS = 128
#: Sketch buckets an octave: values within 1/256 of each other may share one.
OCTAVE = 256
#: Trees after which the rows' margins are computed anew and kept.
RENEW = 10
#: Rows of a partition while there are fewer partitions than cores, and at most.
FEW_ROWS, MOST_ROWS = 4096, 250_000
#: Counts of rows and of class 1 are taken together: a block has fewer rows than this.
PAIR = 1 << 26
#: Nodes that are worth a reducer of their own, while there are fewer than cores.
JUDGED = 16
#: Rows of a node up to which one reducer grows the whole subtree, whatever the table.
LOCAL_ROWS = 1 << 17
#: Rows that are worth a reducer of their own, while there are fewer than cores, and
#: the most rows of a reducer that takes several nodes.
GROWN, MOST_GROWN = 2048, 1 << 18
#: Bytes of histograms that one pass of the forest asks for.
PASS_BYTES = 32 << 20
#: Bytes of rows that a task of a stage that grows all trees keeps, and the seconds that
#: it waits for another one before it gives up.
KEPT_BYTES, PATIENCE = 512 << 20, 3600.0
#: Rows of a node up to which one of these tasks grows the whole subtree: fewer than
#: LOCAL_ROWS, since a step costs little and the others wait meanwhile.
STAGE_ROWS = 1 << 14
#: Share of a column's rows in one bin from which on only the others are summed.
MOST_SHARE = 0.4


@dataclass(frozen=True)
class Boost:
    """``gain``: ``newton`` (sums of gradients and Hessians) or ``friedman``
    (means of gradients, weights of rows); a split must gain more than
    ``least_gain``. ``leaves`` bounds leaf-wise growth; without it every node that
    can be split is. ``rows`` and ``columns`` are the shares that a tree samples.
    ``from_mean`` starts at the log-odds of the weighted classes."""
    trees: int = 200
    rate: float = 0.1
    depth: int | None = 6
    leaves: int | None = None
    gain: str = "newton"
    l2: float = 1.0
    least_gain: float = 0.0
    least_hessian: float = 1.0
    least_rows: int = 1
    least_split: int = 2
    rows: float = 1.0
    columns: float = 1.0
    from_mean: bool = False


@dataclass(frozen=True)
class Forest:
    trees: int = 100
    depth: int = 10
    least_rows: int = 1
    least_split: int = 2
    columns: int | None = None     # None: the square root of their number


@dataclass(frozen=True)
class Task:
    """One model to fit: parameters, class weights, and the fold left out."""
    params: Boost | Forest
    weights: tuple[float, float] = (1.0, 1.0)
    fold: int | None = None
    seed: int = 42


class Nodes(NamedTuple):
    """A tree: inner nodes have feature >= 0 and send bins <= cut to the left."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray


class Block(NamedTuple):
    bins: np.ndarray               # rows x features, one feature after the other
    y: np.ndarray
    key: np.ndarray
    fold: np.ndarray
    margin: np.ndarray             # tasks x rows, or no rows: all are 0
    part: int = 0                  # the partition that it is


# ---------------------------------------------------------------------------
# bins
# ---------------------------------------------------------------------------

def _bucket(x: Column) -> Column:
    """A whole number that grows with x; x of one bucket differ by 1/OCTAVE."""
    size = F.abs(x)
    e = F.floor(F.log2(size))
    of_size = (e + 1100) * OCTAVE + F.floor((size / F.pow(F.lit(2.0), e) - 1.0) * OCTAVE) + 2
    return F.when(x == 0, F.lit(0)).when(x > 0, of_size).otherwise(-of_size).cast("long")


def bin_edges(rows: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending cuts of every feature, at most ``max_bins`` - 1: between
    neighbouring values while there are few, else at quantiles of the sketch.
    Buckets with their counts and outermost values come to the driver: a bounded
    number a feature, whatever the rows."""
    entries = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("x")) for i, c in enumerate(features)]))
    some = rows.select(entries.alias("e")).select("e.f", "e.x").where("x is not null and not isnan(x) and abs(x) < double('Infinity')")
    got = some.groupBy("f", _bucket(F.col("x")).alias("b")).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).toPandas()
    out = []
    for f in range(len(features)):
        mine = got[got["f"] == f].sort_values("b")
        lo, hi, n = (mine[c].to_numpy() for c in ("lo", "hi", "n"))
        if len(lo) > max_bins:
            at = np.searchsorted(np.cumsum(n), np.arange(1, max_bins) * (n.sum() / max_bins), "left")
            last = np.unique(np.minimum(at, len(lo) - 2))
        else:
            last = np.arange(max(len(lo) - 1, 0))
        middle = (hi[last] + lo[last + 1]) / 2 if len(last) else np.zeros(0)
        out.append(np.where(middle < lo[last + 1], middle, hi[last]) if len(last) else middle)
    return out


def blocks(rows: DataFrame, features: list[str], edges: list[np.ndarray], label: str, key: str, fold: str | None = None, tasks: int = 1) -> RDD:
    """The rows as binned blocks, kept in memory or on disk; a lost block is made
    anew from ``rows``, which should be a written table."""
    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.empty((b.num_rows, len(features)), np.uint8)
            for i, c in enumerate(features):
                x[:, i] = np.searchsorted(edges[i], b.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False), "left")
            y, k, o = (np.asarray(b.column(c).fill_null(0).to_numpy(zero_copy_only=False), t) for c, t in (("y", np.uint8), ("k", np.int64), ("o", np.int16)))
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, y, k, o)], ["x", "y", "k", "o"])

    def joined(part: int, some: Iterator) -> Iterator[Block]:
        got = [tuple(np.frombuffer(bytes(v), t) for v, t in zip(r, (np.uint8, np.uint8, np.int64, np.int16))) for r in some]
        if got:
            x, y, k, o = (np.concatenate(v) for v in zip(*got))
            yield Block(np.asfortranarray(x.reshape(len(y), len(features))), y, k, o, np.zeros((tasks, len(y))), part)

    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, -(-n // FEW_ROWS)), -(-n // MOST_ROWS))
    picked = rows.select(F.col(label).cast("int").alias("y"), F.col(key).cast("long").alias("k"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("o"),
                         *[F.col(c).cast("double").alias(c) for c in features]).repartition(parts, "k")
    return picked.mapInArrow(binned, "x binary, y binary, k binary, o binary").rdd.mapPartitionsWithIndex(joined).persist(StorageLevel.MEMORY_AND_DISK)


def mixed(*parts) -> np.ndarray:
    """A 64-bit hash of whole numbers (arrays or scalars), the same everywhere."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
    return h


def uniform(*parts) -> np.ndarray:
    return (mixed(*parts) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


#: Shares of the Poisson distribution with mean 1 up to each count.
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def bag(seed: int, tree: int, key: np.ndarray) -> np.ndarray:
    return np.searchsorted(POISSON, uniform(seed, 1, tree, key), "right").astype(np.float64)


def subset(seed: int, tree: int, node: int, n: int, take: int) -> np.ndarray:
    """The ``take`` features with the smallest hashes of (seed, tree, node)."""
    return np.sort(np.argsort(mixed(seed, 2, tree, node, np.arange(n)), kind="stable")[:take])


def route(tree: Nodes, bins: np.ndarray) -> np.ndarray:
    """The leaf that each row ends in. A missing value goes to the right."""
    inner, n = tree.feature >= 0, len(bins)
    # the children of node i are at 2i (right, just after the left one) and 2i + 1; a leaf is its own child
    child = np.where(inner, tree.left, np.arange(len(inner))).repeat(2)
    child[::2] += inner
    column, cut = np.where(inner, tree.feature, 0) * n, tree.cut.astype(bins.dtype)
    node, every, flat, level = np.zeros(n, np.int64), np.arange(n), bins.ravel(order="F"), np.zeros(1, np.int64)
    while inner[level].any():
        level = np.concatenate([child[2 * level[inner[level]]], child[2 * level[inner[level]] + 1]])
        node = child.take(2 * node + (flat.take(column.take(node) + every) <= cut.take(node)))
    return node


def best_split(gain: np.ndarray) -> tuple[float, int, int] | None:
    """(gain, feature, cut) of the largest entry, the first of equal ones."""
    at = int(gain.argmax())
    return (float(gain.flat[at]), *divmod(at, gain.shape[1])) if gain.flat[at] > -np.inf else None


# ---------------------------------------------------------------------------
# boosting
# ---------------------------------------------------------------------------

def gains(hist: np.ndarray, p: Boost, allowed: np.ndarray) -> np.ndarray:
    """Gain of every (feature, cut); -inf where a cut isn't allowed. ``hist``
    has gradient, Hessian, weight and rows, each summed by (feature, bin)."""
    left = hist.cumsum(axis=2)[:, :, :-1]
    right = hist.sum(axis=2, keepdims=True) - left
    (gl, hl, wl, nl), (gr, hr, wr, nr) = left, right
    with np.errstate(divide="ignore", invalid="ignore"):
        if p.gain == "friedman":
            gain = wl * wr / (wl + wr) * (gl / wl - gr / wr) ** 2
        else:
            gain = gl ** 2 / (hl + p.l2) + gr ** 2 / (hr + p.l2) - (gl + gr) ** 2 / (hl + hr + p.l2)
    ok = (nl >= max(p.least_rows, 1)) & (nr >= max(p.least_rows, 1)) & (hl >= p.least_hessian) & (hr >= p.least_hessian)
    ok &= allowed[:, None] & (gain > p.least_gain) & (nl + nr >= p.least_split)
    return np.where(ok, gain, -np.inf)


@dataclass
class _Growing:
    """A tree in the making: ``best`` of known nodes, ``total`` of all (gradient,
    Hessian, weight, rows), children of those that were expanded, ``wanted``, the
    nodes to be summed next, and ``small``, those whose subtrees are to be grown
    next, with their rows: nodes of at most ``local`` rows."""
    params: Boost
    allowed: np.ndarray
    local: int = 0
    nodes: list[list] = field(default_factory=lambda: [[-1, 0, -1, -1, 0]])     # feature, cut, left, right, depth
    best: dict[int, tuple] = field(default_factory=dict)
    wanted: list[int] = field(default_factory=lambda: [0])
    small: dict[int, int] = field(default_factory=dict)
    low: dict[int, np.ndarray] = field(default_factory=dict)     # totals left of the best split
    total: dict[int, np.ndarray] = field(default_factory=dict)
    place: dict[int, int] = field(default_factory=lambda: {0: 1})     # 1, children of i: 2i and 2i + 1

    def frozen(self) -> Nodes:
        inner, cut, left, right = (np.array([n[j] for n in self.nodes]) for j in range(4))
        z = np.zeros(len(inner))
        return Nodes(inner, cut, left, right, z, z)

    def learn(self, found: list[tuple], grown: list[tuple] = ()) -> None:
        """Take the wanted nodes' totals and best splits and the small nodes'
        subtrees, and ask for what is needed next."""
        for node, (total, best, low) in zip(self.wanted, found):
            self.total[node], self.best[node], self.low[node] = total, best, low
        for node, (total, *splits) in zip(self.small, grown):
            self.graft(node, total, *splits)
        self.wanted, self.small, p = [], {}, self.params
        for node in self.committed()[1]:
            for c in self.expand(node):
                # leaves that can't be split need no histogram
                if (p.depth is None or self.nodes[c][4] < p.depth) and self.total[c][3] >= max(2 * p.least_rows, 2, p.least_split) and self.total[c][1] >= 2 * p.least_hessian:
                    self.ask(c, int(self.total[c][3]))

    def ask(self, node: int, rows: int) -> None:
        if rows <= self.local:
            self.small[node] = rows
        else:
            self.wanted.append(node)

    def expand(self, node: int) -> tuple[int, int]:
        """Make the children of a node by its best split."""
        _, f, cut = self.best[node]
        low, high = len(self.nodes), len(self.nodes) + 1
        depth = self.nodes[node][4] + 1
        self.nodes += [[-1, 0, -1, -1, depth], [-1, 0, -1, -1, depth]]
        self.nodes[node][:4] = [f, cut, low, high]
        self.total[low], self.total[high] = self.low[node], self.total[node] - self.low[node]
        self.place[low], self.place[high] = 2 * self.place[node], 2 * self.place[node] + 1
        return low, high

    def graft(self, node: int, total: np.ndarray, at: np.ndarray, split: np.ndarray, sums: np.ndarray) -> None:
        """Take over a subtree that ``splits`` gave."""
        self.total[node], numbers = total, [node]
        for i, (f, cut), (gain, *low) in zip(at.tolist(), split.tolist(), sums.tolist()):
            self.best[numbers[i]], self.low[numbers[i]] = (gain, f, cut), np.array(low)
            numbers += self.expand(numbers[i])

    def splits(self) -> tuple[np.ndarray, ...]:
        """The committed tree to send: the root's total, and split by split the node,
        (feature, cut), (gain, sums to the left); children get the next two numbers."""
        chosen, numbers, rows = self.committed()[0], [0], []
        for i, node in enumerate(numbers):
            if node in chosen:
                gain, f, cut = self.best[node]
                rows.append((i, (f, cut), (gain, *self.low[node])))
                numbers += self.nodes[node][2:4]
        at, split, sums = zip(*rows) if rows else ((), (), ())
        return self.total[0], np.array(at, np.int32), np.array(split, np.int32).reshape(-1, 2), np.array(sums).reshape(-1, 5)

    def committed(self) -> tuple[set[int], list[int]]:
        """The splits that best-first growth makes as far as that is known, and
        the leaves to expand: the next one that it splits, and those that it may
        split after that within the budget of leaves."""
        room = (self.params.leaves or 1 << 30) - 1
        queue = [(-self.best[0][0], 1, 0)] if self.best.get(0) else []
        done, ask, seen = set(), [], 0
        while queue and seen < room:
            *_, node = heapq.heappop(queue)
            seen += 1
            if self.nodes[node][0] < 0:
                ask.append(node)
                continue
            if not ask:
                done.add(node)
            for child in self.nodes[node][2:4]:
                if self.best.get(child):
                    heapq.heappush(queue, (-self.best[child][0], self.place[child], child))
        return done, ask

    def finished(self) -> Nodes:
        """The committed tree, nodes numbered anew, with leaf values."""
        chosen, p = self.committed()[0], self.params
        order, number = [0], {0: 0}
        for node in order:
            if node in chosen:
                for child in self.nodes[node][2:4]:
                    number[child] = len(order)
                    order.append(child)
        rows = []
        for node in order:
            f, cut, low, high, _ = self.nodes[node]
            g, h = self.total[node][:2]
            if node in chosen:
                rows.append((f, cut, number[low], number[high], 0.0, self.best[node][0]))
            else:
                rows.append((-1, 0, -1, -1, -p.rate * g / (h + p.l2) if h + p.l2 > 0 else 0.0, 0.0))
        return Nodes(*(np.array(c) for c in zip(*rows)))


def _task_rows(block: Block, task: Task) -> np.ndarray:
    """Weight of each row: its class's, 0 in the fold that is left out."""
    w = np.where(block.y == 1, task.weights[1], task.weights[0])
    return w if task.fold is None else w * (block.fold != task.fold)


#: What a worker process has worked out for its blocks, so that the next pass needn't
#: do it again: nothing depends on it, and it is dropped when it outgrows its bytes.
_known: dict[tuple, tuple] = {}
KNOWN_BYTES = 128 << 20


def _rounded(w: np.ndarray, y: np.ndarray, margin: np.ndarray, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and Hessians as multiples of 1 / ``unit``."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint(w * (p - y) * unit) / unit, np.rint(w * p * (1 - p) * unit) / unit


def _gradients(block: Block, at: int, task: Task, start: float, recent: list[Nodes], tree: int, unit: float, run: str) -> tuple[np.ndarray, ...]:
    """Weight, gradient and Hessian of each row after the trees so far."""
    w = _task_rows(block, task)
    if task.params.rows < 1:
        w = w * (uniform(task.seed, 3, tree, block.key) < task.params.rows)
    first, name = tree - len(recent), (run, at, block.part)
    known = _known.get(name)
    if known is None or known[0] != first or known[1] > tree:
        known = (first, first, np.zeros(len(w)), None, None)
    _, upto, added, g, h = known
    if upto < tree or g is None:
        for t in recent[upto - first:]:
            added = added + t.value.take(route(t, block.bins))
        g, h = _rounded(w, block.y, start + (block.margin[at] if len(block.margin) else 0.0) + added, unit)
        if any(k[0] != run for k in _known) or sum(len(k[2]) for k in _known.values()) * 24 > KNOWN_BYTES:
            _known.clear()
        _known[name] = (first, tree, added, g, h)
    return w, g, h


def _dealt(nodes: int, reducers: int) -> list[int]:
    """Where each reducer's run of the nodes starts, and their end."""
    return [nodes * i // reducers for i in range(reducers + 1)]


def _spread(rows: list[int], cores: int) -> list[int]:
    """A reducer for each small node: the largest nodes first, each to the reducer
    that has the fewest rows."""
    cost = [n + GROWN // 8 for n in rows]
    loads = [(0, i) for i in range(max(min(cores, -(-sum(cost) // GROWN)), -(-sum(cost) // MOST_GROWN), 1))]
    out = [0] * len(rows)
    for node in sorted(range(len(rows)), key=lambda i: -cost[i]):
        load, i = loads[0]
        heapq.heapreplace(loads, (load + cost[node], i))
        out[node] = i
    return out


def _found(data: RDD, sums: Callable[[Iterator[Block]], Iterator], sizes: list[int], judge: Callable[[int, np.ndarray], tuple],
           rows: list[int] = (), grow: Callable[[int, list[tuple]], tuple] | None = None) -> list[tuple]:
    """``judge`` (number, sums) of every node, then ``grow`` (number, rows) of every
    small node, in order. ``sums`` gives a partition's sums of all nodes, flat,
    ``sizes`` numbers each, and (number, rows) of small nodes; reducers add the sums and
    judge the nodes, or grow their subtrees, so no histogram and no row comes to the
    driver."""
    cores, n = data.context.defaultParallelism, len(sizes)
    reducers = min(-(-n // JUDGED), cores)
    ends, cuts, place = np.concatenate([[0], np.cumsum(sizes)]).astype(int), _dealt(n, max(reducers, 1)), _spread(rows, cores)

    def parts(some: Iterator[Block]) -> Iterator[tuple[int, tuple]]:
        for got in sums(some):
            if isinstance(got, tuple):
                yield reducers + place[got[0]], got
            else:
                for i in range(reducers):
                    yield i, (-1, got[ends[cuts[i]]:ends[cuts[i + 1]]])

    def judged(some: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, tuple]]:
        total: dict[int, np.ndarray] = {}
        small: dict[int, list[tuple]] = {}
        for i, (number, got) in some:
            if number >= 0:
                small.setdefault(number, []).append(got)
            elif i in total:
                total[i] += got
            else:
                total[i] = got.copy()
        for i, flat in total.items():
            for node in range(cuts[i], cuts[i + 1]):
                yield node, judge(node, flat[ends[node] - ends[cuts[i]]:ends[node + 1] - ends[cuts[i]]])
        for number in sorted(small):
            yield n + number, grow(number, small.pop(number))

    found = data.mapPartitions(parts).partitionBy(reducers + max(place, default=-1) + 1, int).mapPartitions(judged).collect()
    if len(found) != n + len(rows):
        raise ValueError("no rows to learn from")
    return [f for _, f in sorted(found, key=lambda f: f[0])]


def _histograms(mine: np.ndarray, nodes: int, columns: list[np.ndarray], values: list[np.ndarray], n_bins: list[int]) -> np.ndarray:
    """Gradient, Hessian, rows and rows of class 1 by (node, bin of a feature)."""
    sums, first = np.empty((4, nodes, sum(n_bins))), 0
    for column, n in zip(columns, n_bins):
        cell = mine * n + column
        g_f, h_f, pairs = (np.bincount(cell, v, nodes * n).reshape(-1, n) for v in values)
        ones = np.floor(pairs / PAIR)
        for i, v in enumerate((g_f, h_f, pairs - ones * PAIR, ones)):
            sums[i, :, first:first + n] = v
        first += n
    return sums.transpose(1, 0, 2)


def _sums(work: list[tuple], n_bins: list[int], unit: float, run: str, some: Iterator[Block]) -> Iterator[np.ndarray | tuple]:
    """The histograms of the wanted nodes of all tasks, flat, summed over a
    partition; and number and rows of the small ones."""
    total = None
    for block in some:
        out = []
        pair = 1.0 + block.y * float(PAIR)
        for at, task, start, recent, tree, growing, wanted, small in work:
            w, g, h = _gradients(block, at, task, start, recent, tree, unit, run)
            slot = np.full(len(growing.feature), -1)
            slot[wanted] = np.arange(len(wanted))
            slot[[node for node, _ in small]] = np.arange(len(wanted), len(wanted) + len(small))
            mine = slot.take(route(growing, block.bins))
            if small:
                on = np.flatnonzero((mine >= len(wanted)) & (w > 0))
                on = on[np.argsort(mine[on], kind="stable")]
                ends = np.searchsorted(mine[on], np.arange(len(wanted), len(wanted) + len(small) + 1))
                for (node, number), low, high in zip(small, ends, ends[1:]):
                    rows = on[low:high]
                    if len(rows) or not node:
                        yield number, (block.bins[rows].tobytes(), g[rows], h[rows], block.y[rows])
            if wanted:
                on = np.flatnonzero((mine >= 0) & (mine < len(wanted)) & (w > 0))
                out.append(_histograms(mine[on], len(wanted), [c[on] for c in block.bins.T], [v[on] for v in (g, h, pair)], n_bins).ravel())
        if out:
            out = np.concatenate(out)
            total = out if total is None else total + out
    if total is not None:
        yield total


def _subtree(asked: list[tuple], n_bins: list[int], unit: float, number: int, some: list[tuple]) -> tuple:
    """Grow what is below a small node from its rows, by the steps that make a whole
    tree: total and splits (``_Growing.splits``)."""
    task, allowed, depth = asked[number]
    bins = np.asfortranarray(np.concatenate([np.frombuffer(r[0], np.uint8) for r in some]).reshape(-1, len(n_bins)))
    g, h, y = (np.concatenate([r[i] for r in some]) for i in (1, 2, 3))
    values, columns = [g, h, 1.0 + y * float(PAIR)], list(bins.T)
    tree = _Growing(task.params, allowed)
    tree.nodes[0][4] = depth
    known: dict[int, np.ndarray] = {}      # histograms of nodes that may still be split
    while tree.wanted:
        # the larger child is its parent less the smaller one: all sums are exact
        split = {node: sorted(tree.nodes[node][2:4], key=lambda c: tree.total[c][3]) for node in known if tree.nodes[node][0] >= 0}
        summed = [low for low, high in split.values() if low in tree.wanted or high in tree.wanted] or tree.wanted
        slot = np.full(len(tree.nodes), -1)
        slot[summed] = np.arange(len(summed))
        mine = slot.take(route(tree.frozen(), bins))
        on = np.flatnonzero(mine >= 0)
        hist = dict(zip(summed, _histograms(mine[on], len(summed), [c[on] for c in columns], [v[on] for v in values], n_bins)))
        for node, (low, high) in split.items():
            whole = known.pop(node)
            if high in tree.wanted:
                hist[high] = whole - hist[low]
        known.update((node, hist[node]) for node in tree.wanted)
        tree.learn([_split([(task, allowed)], n_bins, unit, 0, known[node].ravel()) for node in tree.wanted])
        known = {node: h for node, h in known.items() if tree.best[node]}
    return tree.splits()


def _split(asked: list[tuple], n_bins: list[int], unit: float, node: int, flat: np.ndarray) -> tuple:
    """Total, best split and the sums to its left of one node."""
    task, allowed = asked[node]
    g, h, n, ones = flat.reshape(4, -1)
    w0, w1 = (np.rint(w * unit) / unit for w in task.weights)
    hist = np.zeros((4, len(n_bins), max(n_bins)))
    cells = np.flatnonzero(np.arange(max(n_bins)) < np.array(n_bins)[:, None])
    for sums, v in zip(hist.reshape(4, -1), (g, h, (n - ones) * w0 + ones * w1, n)):
        sums[cells] = v
    best = best_split(gains(hist, task.params, allowed))
    return hist[:, 0].sum(axis=1), best, hist[:, best[1], :best[2] + 1].sum(axis=1) if best else None


def _renewed(added: list[list[Nodes]], block: Block) -> Block:
    margin = block.margin.copy() if len(block.margin) else np.zeros((len(added), len(block.y)))
    for at, trees in enumerate(added):
        for t in trees:
            margin[at] += t.value[route(t, block.bins)]
    return block._replace(margin=margin)


def _begun(task: Task, tree: int, width: int, counts: dict[tuple[int, int], int], local: int) -> _Growing:
    allowed = uniform(task.seed, 4, tree, np.arange(width)) < task.params.columns
    new = _Growing(task.params, allowed if allowed.any() else np.ones(width, bool), local, wanted=[])
    new.ask(0, sum(n for (f, _), n in counts.items() if f != task.fold))
    return new


def boost(data: RDD, tasks: list[Task], edges: list[np.ndarray], counts: dict[tuple[int, int], int], features: list[str]) -> list[TreeModel]:
    """Fit all tasks together. ``counts``: rows by (fold, class)."""
    width, n_bins = len(edges), [len(e) + 1 for e in edges]
    heavy = max(sum(n * t.weights[c] for (_, c), n in counts.items()) for t in tasks)
    unit = 2.0 ** (52 - max(22, math.ceil(math.log2(max(heavy, 1.0)))))
    starts = []
    for t in tasks:
        by = [sum(n * t.weights[c] for (f, c), n in counts.items() if c == y and f != t.fold) for y in (0, 1)]
        starts.append(math.log(by[1] / by[0]) if t.params.from_mean and min(by) > 0 else 0.0)
    stage = _stage_of(data, sum(counts.values()) * (5 * width + 11 + 48 * len(tasks)))
    models = (partial(_side_by_side, *stage) if stage else _pass_by_pass)(data, tasks, starts, n_bins, counts, unit)
    return [TreeModel("boost", features, s, [_with_thresholds(t, edges) for t in m], _importance(m, width)) for s, m in zip(starts, models)]


def _pass_by_pass(data: RDD, tasks: list[Task], starts: list[float], n_bins: list[int], counts: dict[tuple[int, int], int], unit: float) -> list[list[Nodes]]:
    """The trees of all tasks, a job a pass."""
    models = [[] for _ in tasks]
    grown, kept = {}, [0] * len(tasks)      # trees that the margins hold
    base, older, run = data, None, uuid.uuid4().hex
    while True:
        for at, t in enumerate(tasks):
            if at not in grown and len(models[at]) < t.params.trees:
                grown[at] = _begun(t, len(models[at]), len(n_bins), counts, LOCAL_ROWS)
        if not grown:
            break
        if sum(map(len, models)) - sum(kept) >= RENEW * len(tasks):
            older, added, kept = data, [m[k:] for m, k in zip(models, kept)], [len(m) for m in models]
            data = data.map(partial(_renewed, added)).persist(StorageLevel.MEMORY_AND_DISK)
        work, asked, small = [], [], []
        for at, g in sorted(grown.items()):
            work.append((at, tasks[at], starts[at], models[at][kept[at]:], len(models[at]), g.frozen(), g.wanted, [(node, len(small) + i) for i, node in enumerate(g.small)]))
            asked += [(tasks[at], g.allowed) for _ in g.wanted]
            small += [(rows, (tasks[at], g.allowed, g.nodes[node][4])) for node, rows in g.small.items()]
        found = iter(_found(data, partial(_sums, work, n_bins, unit, run), [4 * sum(n_bins)] * len(asked), partial(_split, asked, n_bins, unit),
                            [rows for rows, _ in small], partial(_subtree, [s for _, s in small], n_bins, unit)))
        sums, subtrees = [next(found) for _ in asked], list(found)
        if older is not None and older is not base:
            older.unpersist()
        older = None
        sums, subtrees = iter(sums), iter(subtrees)
        for at, *_, wanted, of_rows in work:
            g = grown[at]
            g.learn([next(sums) for _ in wanted], [next(subtrees) for _ in of_rows])
            if not g.wanted and not g.small:
                models[at].append(grown.pop(at).finished())
    if data is not base:
        data.unpersist()
    return models


# ---------------------------------------------------------------------------
# boosting in one stage
# ---------------------------------------------------------------------------

def _stage_of(data: RDD, held: int) -> tuple[str, int] | None:
    """A folder and the number of tasks of a stage that grows all trees, or None: its
    tasks must all run at once, share a machine (they meet through files, since a
    barrier of Spark's takes a second) and keep ``held`` bytes between them."""
    sc = data.context
    at = urlsplit(sc.getCheckpointDir() or "none:")
    if not sc.master.startswith("local") or at.scheme not in ("", "file") or sc.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return None
    jsc = sc._jsc.sc()
    tasks = min(data.getNumPartitions(), jsc.maxNumConcurrentTasks(jsc.resourceProfileManager().defaultResourceProfile()))
    return (f"{at.path.rstrip('/')}/boost-{uuid.uuid4().hex}", tasks) if tasks > 1 and held <= tasks * KEPT_BYTES else None


class _Mail:
    """What the tasks of a stage hand each other: files in a folder that all see. A file
    is there as a whole or not at all, and goes when all have posted the next one."""

    def __init__(self, folder: str, me: int, tasks: int):
        self.folder, self.me, self.tasks, self.step = folder, me, tasks, 0

    def deal(self, parcels: list[bytes]) -> list[bytes]:
        """What each task has for this one. ``parcels``: one for each task, or one for all."""
        path = f"{self.folder}/{self.step}-{self.me}"
        with open(f"{path}-", "wb") as out:
            out.write(np.cumsum([0, *map(len, parcels)], dtype=np.int64).tobytes())
            out.writelines(parcels)
        os.replace(f"{path}-", path)
        got = [self.read(f"{self.folder}/{self.step}-{task}", len(parcels)) for task in range(self.tasks)]
        if self.step:
            os.remove(f"{self.folder}/{self.step - 1}-{self.me}")
        self.step += 1
        return got

    def read(self, path: str, parcels: int) -> bytes:
        pause, until = 1e-4, time.monotonic() + PATIENCE
        while not os.path.exists(path):
            if time.monotonic() > until:
                raise TimeoutError(f"no {path}")
            time.sleep(pause)
            pause = min(1.2 * pause, 5e-3)
        with open(path, "rb") as got:
            ends = np.frombuffer(got.read(8 * (parcels + 1)), np.int64)
            at = self.me if parcels > 1 else 0
            got.seek(int(ends[at]), os.SEEK_CUR)
            return got.read(int(ends[at + 1] - ends[at]))


class _Columns:
    """The bins of a task's rows by column, sums over them by bin."""

    def __init__(self, block: Block, n_bins: list[int]):
        self.bins, self.n_bins, self.ends = list(block.bins.T), n_bins, np.cumsum([0, *n_bins])
        counts = [np.bincount(c, minlength=n) for c, n in zip(self.bins, n_bins)]
        self.common = [int(c.argmax()) for c in counts]
        self.skewed = [c.max() > MOST_SHARE * c.sum() for c in counts]
        # the rows by bin, where each bin that has any starts, and its place in the sums
        self.order = [np.argsort(c, kind="stable").astype(np.int32) for c in self.bins]
        self.start = [(np.cumsum(c) - c)[c > 0] for c in counts]
        self.place = np.concatenate([first + np.flatnonzero(c) for first, c in zip(self.ends, counts)])

    def of_all(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.ends[-1], values.dtype)
        if len(values):
            out[self.place] = np.concatenate([np.add.reduceat(values.take(o), at) for o, at in zip(self.order, self.start)])
        return out

    def of(self, rows: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
        out, values = np.empty((len(values), self.ends[-1])), [v.take(rows) for v in values]
        whole = [v.sum() for v in values]
        for column, n, first, common, skewed in zip(self.bins, self.n_bins, self.ends, self.common, self.skewed):
            cell, some = column.take(rows), values
            if skewed:
                # all sums are exact, so the common bin has what the others leave
                on = np.flatnonzero(cell != common)
                cell, some = cell.take(on), [v.take(on) for v in values]
            cell = cell.astype(np.intp)
            for sums, v, total in zip(out, some, whole):
                found = sums[first:first + n]
                found[:] = np.bincount(cell, v, n)
                if skewed:
                    found[common] = total - found.sum()
        return out


class _Mine:
    """A model's rows in one task of the stage: margins, and of the tree in the making
    gradients and Hessians, the rows of its open nodes and their histograms."""

    def __init__(self, block: Block, columns: _Columns, task: Task, start: float, unit: float):
        self.block, self.columns, self.task, self.start, self.unit = block, columns, task, start, unit
        self.margin, self.added = np.zeros(len(block.y)), np.zeros(len(block.y))
        self.pair, self.counts = 1.0 + block.y * float(PAIR), None

    def begin(self, tree: int) -> None:
        w = _task_rows(self.block, self.task)
        if self.task.params.rows < 1:
            w = w * (uniform(self.task.seed, 3, tree, self.block.key) < self.task.params.rows)
        self.g, self.h = _rounded(w, self.block.y, self.start + self.margin + self.added, self.unit)
        self.rows, self.sums = {0: np.flatnonzero(w > 0).astype(np.int32)}, {}

    def summed(self, node: int) -> np.ndarray:
        rows, out = self.rows[node], np.empty((4, self.columns.ends[-1]))
        if node:
            out[:3] = self.columns.of(rows, [self.g, self.h, self.pair])
        else:
            if self.counts is None or self.task.params.rows < 1:
                counted = np.zeros(len(self.pair))
                counted[rows] = self.pair[rows]
                self.counts = self.columns.of_all(counted)
            both = self.columns.of_all(self.g + 1j * self.h)
            out[0], out[1], out[2] = both.real, both.imag, self.counts
        out[3] = np.floor(out[2] / PAIR)
        out[2] -= out[3] * PAIR
        return out

    def wanted(self, tree: _Growing) -> list[np.ndarray]:
        """The histograms of the nodes that the tree asks for: of two children only
        the smaller one's rows are summed, as all sums are exact."""
        for node in [n for n in self.rows if tree.nodes[n][0] >= 0]:
            f, cut, low, high, _ = tree.nodes[node]
            rows, whole = self.rows.pop(node), self.sums.pop(node)
            left = self.block.bins[:, f].take(rows) <= cut
            self.rows[low], self.rows[high] = rows[left], rows[~left]
            less, more = sorted((low, high), key=lambda c: tree.total[c][3])
            if less in tree.wanted or more in tree.wanted:
                self.sums[less] = self.summed(less)
            if more in tree.wanted:
                self.sums[more] = whole - self.sums[less]
        if 0 in tree.wanted:
            self.sums[0] = self.summed(0)
        return [self.sums[node] for node in tree.wanted]

    def small(self, tree: _Growing) -> list[tuple]:
        out = []
        for node in tree.small:
            rows = self.rows.pop(node)
            out.append((self.block.bins[rows].tobytes(), self.g[rows], self.h[rows], self.block.y[rows]))
        return out

    def prune(self, tree: _Growing) -> None:
        """Drop the nodes that won't be split."""
        self.rows = {node: rows for node, rows in self.rows.items() if tree.best.get(node)}
        self.sums = {node: self.sums[node] for node in self.rows}

    def add(self, trees: list[Nodes], renew: bool) -> None:
        for t in trees:
            values = t.value.take(route(t, self.block.bins))
            if renew:
                self.margin += values
            else:
                self.added += values
        if renew:
            self.added[:] = 0.0


def _grow_all(folder: str, stage: int, tasks: list[Task], starts: list[float], n_bins: list[int], counts: dict[tuple[int, int], int], unit: float, local: int, _: Iterator) -> Iterator[list[list[Nodes]]]:
    """What a task of the stage does: the steps of ``_pass_by_pass``, all of them in
    each task, since each learns of all that was found; sums and judging are dealt."""
    context = BarrierTaskContext.get()
    me = context.partitionId()
    mail = _Mail(f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}", me, stage)
    os.makedirs(mail.folder, exist_ok=True)
    mail.deal([b""])
    got = [pickle.loads(pathlib.Path(f).read_bytes()) for f in sorted(glob.glob(f"{folder}/block-*")) if int(f.rsplit("-", 1)[1]) % stage == me]
    if not got:
        got = [Block(np.zeros((0, len(n_bins)), np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int16), np.zeros((0, 0)))]
    block = Block(np.asfortranarray(np.concatenate([b.bins for b in got])), *[np.concatenate([b[i] for b in got]) for i in (1, 2, 3)], np.zeros((0, 0)))
    del got
    columns = _Columns(block, n_bins)
    mine = [_Mine(block, columns, t, s, unit) for t, s in zip(tasks, starts)]
    models, grown, kept = [[] for _ in tasks], {}, [0] * len(tasks)
    while True:
        if sum(map(len, models)) - sum(kept) >= RENEW * len(tasks):
            for at, m in enumerate(models):
                mine[at].add(m[kept[at]:], True)
            kept = [len(m) for m in models]
        for at, t in enumerate(tasks):
            if at not in grown and len(models[at]) < t.params.trees:
                grown[at] = _begun(t, len(models[at]), len(n_bins), counts, local)
                mine[at].begin(len(models[at]))
        if not grown:
            break
        parcels, asked, small = [([], []) for _ in range(stage)], [], []
        sizes = [n for _, g in sorted(grown.items()) for n in g.small.values()]
        place = [stage - 1 - p % stage for p in _spread(sizes, stage)]
        for at, g in sorted(grown.items()):
            for sums in mine[at].wanted(g):
                parcels[len(asked) % stage][0].append(sums)
                asked.append((tasks[at], g.allowed))
            for node, rows in zip(g.small, mine[at].small(g)):
                parcels[place[len(small)]][1].append((len(small), rows))
                small.append((tasks[at], g.allowed, g.nodes[node][4]))
        mailed = [pickle.loads(p) for p in mail.deal([pickle.dumps(p, 5) for p in parcels])]
        found = [(node, _split(asked, n_bins, unit, node, sum(m[0][i] for m in mailed).ravel())) for i, node in enumerate(range(me, len(asked), stage))]
        found += [(len(asked) + number, _subtree(small, n_bins, unit, number, [m[1][i][1] for m in mailed])) for i, (number, _) in enumerate(mailed[0][1])]
        del mailed
        found = sorted((f for p in mail.deal([pickle.dumps(found, 5)]) for f in pickle.loads(p)), key=lambda f: f[0])
        sums, subtrees = iter([f for _, f in found[:len(asked)]]), iter([f for _, f in found[len(asked):]])
        for at, g in sorted(grown.items()):
            g.learn([next(sums) for _ in g.wanted], [next(subtrees) for _ in g.small])
            mine[at].prune(g)
            if not g.wanted and not g.small:
                models[at].append(grown.pop(at).finished())
                mine[at].add(models[at][-1:], False)
    if not me:
        yield models


def _side_by_side(folder: str, stage: int, data: RDD, tasks: list[Task], starts: list[float], n_bins: list[int], counts: dict[tuple[int, int], int], unit: float) -> list[list[Nodes]]:
    """The trees of all tasks by one stage that runs from the first to the last."""
    def post(some: Iterator[Block]) -> Iterator[int]:
        for block in some:
            at = pathlib.Path(folder, uuid.uuid4().hex)
            at.write_bytes(pickle.dumps(block._replace(margin=np.zeros((0, 0))), 5))
            at.replace(f"{folder}/block-{block.part}")
            yield len(block.y)

    os.makedirs(folder)
    try:
        if not sum(data.mapPartitions(post).collect()):
            raise ValueError("no rows to learn from")
        grow = partial(_grow_all, folder, stage, tasks, starts, n_bins, counts, unit, STAGE_ROWS)
        return data.context.parallelize(range(stage), stage).barrier().mapPartitions(grow).collect()[0]
    finally:
        shutil.rmtree(folder, ignore_errors=True)


# ---------------------------------------------------------------------------
# forest
# ---------------------------------------------------------------------------

def gini_gains(hist: np.ndarray, weights: tuple[float, float], least_rows: int) -> np.ndarray:
    """Weighted Gini decrease of every (feature, cut) from counts by class."""
    left = hist.cumsum(axis=1)[:, :-1]
    whole = hist.sum(axis=1, keepdims=True)
    right, w = whole - left, np.array(weights)

    def impure(c: np.ndarray) -> np.ndarray:
        s = c * w
        total = s.sum(axis=2)
        return total - np.divide((s ** 2).sum(axis=2), total, out=np.zeros_like(total), where=total > 0)

    gain = impure(whole) - impure(left) - impure(right)
    ok = (left.sum(axis=2) >= max(least_rows, 1)) & (right.sum(axis=2) >= max(least_rows, 1)) & (gain > 1e-12)
    return np.where(ok, gain, -np.inf)


def _bag_sums(work: list[tuple], n_bins: int, some: Iterator[Block]) -> Iterator[np.ndarray]:
    total = None
    for block in some:
        out, flat = [], block.bins.ravel(order="F")
        for task, tree, nodes, wanted, picked in work:
            weight = bag(task.seed, tree, block.key)
            if task.fold is not None:
                weight = weight * (block.fold != task.fold)
            slot = np.full(len(nodes.feature), -1)
            slot[wanted] = np.arange(len(wanted))
            mine = slot.take(route(nodes, block.bins))
            on = np.flatnonzero((weight > 0) & (mine >= 0))
            mine, weight, y = mine[on], weight[on], block.y[on]
            sums = np.empty((len(wanted), picked.shape[1], 2 * n_bins))
            for j in range(picked.shape[1]):
                cell = (mine * n_bins + flat.take((picked[:, j] * len(block.y)).take(mine) + on)) * 2 + y
                sums[:, j] = np.bincount(cell, weight, len(wanted) * n_bins * 2).reshape(len(wanted), -1)
            out.append(sums.ravel())
        out = np.concatenate(out)
        total = out if total is None else total + out
    if total is not None:
        yield total


def _bag_split(asked: list[tuple], n_bins: int, node: int, flat: np.ndarray) -> tuple:
    """Rows by class, best split and the rows to its left of one node; the
    feature is given by its place among the node's."""
    task, take = asked[node]
    hist = flat.reshape(take, n_bins, 2)
    by = hist[0].sum(axis=0)
    found = best_split(gini_gains(hist, task.weights, task.params.least_rows)) if by.sum() >= task.params.least_split else None
    return by, found, hist[found[1], :found[2] + 1].sum(axis=0) if found else None


def forest(data: RDD, tasks: list[Task], edges: list[np.ndarray], features: list[str]) -> list[TreeModel]:
    """Fit all trees of all tasks level by level."""
    width, n_bins = len(edges), max([len(e) for e in edges], default=0) + 1
    trees = {(a, t): [[-1, 0, -1, -1, 0.0, 0.0]] for a, task in enumerate(tasks) for t in range(task.params.trees)}
    takes = [min(width, task.params.columns or max(1, int(math.sqrt(width)))) for task in tasks]
    room = max(1, PASS_BYTES // (max(takes) * n_bins * 16))
    level = [(a, t, 0) for a, t in trees]
    for depth in range(max(task.params.depth for task in tasks) + 1):
        following = []
        for at in range(0, len(level), room):
            asked, work = {}, []
            for a, t, node in level[at:at + room]:
                asked.setdefault((a, t), []).append(node)
            for (a, t), nodes in asked.items():
                picked = np.array([subset(tasks[a].seed, t, n, width, takes[a]) for n in nodes])
                work.append((tasks[a], t, _nodes(trees[a, t]), np.array(nodes), picked))
            each = [(tasks[a], takes[a]) for (a, _), nodes in asked.items() for _ in nodes]
            judged = iter(_found(data, partial(_bag_sums, work, n_bins), [take * n_bins * 2 for _, take in each], partial(_bag_split, each, n_bins)))
            for ((a, t), nodes), (task, _, _, _, picked) in zip(asked.items(), work):
                for node, columns in zip(nodes, picked):
                    by, found, left = next(judged)
                    mine = trees[a, t]
                    if not node:
                        mine[0][4] = _share(by, task.weights)
                    if not found or depth == task.params.depth:
                        continue
                    low = len(mine)
                    mine[node][:4], mine[node][5] = [int(columns[found[1]]), found[2], low, low + 1], found[0]
                    for child, c in ((low, left), (low + 1, by - left)):
                        mine.append([-1, 0, -1, -1, _share(c, task.weights), 0.0])
                        if depth + 1 < task.params.depth and c.min() > 0 and c.sum() >= task.params.least_split:
                            following.append((a, t, child))
        level = following
        if not level:
            break
    out = []
    for a, task in enumerate(tasks):
        grown = [_nodes(trees[a, t]) for t in range(task.params.trees)]
        out.append(TreeModel("forest", features, 0.0, [_with_thresholds(t, edges) for t in grown], _importance(grown, width, each=True)))
    return out


def _share(by: np.ndarray, weights: tuple[float, float]) -> float:
    """Weighted share of class 1."""
    total = float((by * weights).sum())
    return by[1] * weights[1] / total if total else 0.5


def _nodes(rows: list[list]) -> Nodes:
    return Nodes(*(np.array(c) for c in zip(*rows)))


# ---------------------------------------------------------------------------
# models
# ---------------------------------------------------------------------------

def _with_thresholds(t: Nodes, edges: list[np.ndarray]) -> Nodes:
    """Cuts as values of the features."""
    return t._replace(cut=np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)]))


def _importance(trees: list[Nodes], width: int, each: bool = False) -> np.ndarray:
    """Share of the gain by feature; ``each`` tree counts the same (forest)."""
    total = np.zeros(width)
    for t in trees:
        one = np.bincount(t.feature[t.feature >= 0], t.gain[t.feature >= 0], width)
        total += one / one.sum() if each and one.sum() > 0 else one
    return total / total.sum() if total.sum() > 0 else total


@dataclass
class TreeModel:
    """Trees with thresholds: ``boost`` adds their values to ``start`` and takes
    the logistic function, ``forest`` averages them."""
    kind: str
    features: list[str]
    start: float
    trees: list[Nodes]
    importance: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        x, total = np.asfortranarray(x), np.zeros(len(x))
        for t in self.trees:
            total += t.value.take(route(t, x))
        return total / max(len(self.trees), 1) if self.kind == "forest" else 1.0 / (1.0 + np.exp(-(self.start + total)))

    def rows(self) -> Iterator[tuple]:
        for i, t in enumerate(self.trees):
            for j, r in enumerate(zip(*t)):
                yield (i, j, int(r[0]), float(r[1]), int(r[2]), int(r[3]), float(r[4]), float(r[5]))

    def save(self, spark: SparkSession, path: str) -> None:
        """Two tables: the trees' nodes, and kind, start and importances."""
        spark.createDataFrame(pd.DataFrame(list(self.rows()), columns=["tree", "node", "feature", "cut", "left", "right", "value", "gain"]),
                              "tree int, node int, feature int, cut double, left int, right int, value double, gain double").write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(self.kind, self.features, self.start, [float(v) for v in self.importance])],
                              "kind string, features array<string>, start double, importance array<double>").write.mode("overwrite").parquet(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        head = spark.read.parquet(f"{path}/model").first()
        got = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
        trees = [Nodes(*(t[c].to_numpy() for c in ("feature", "cut", "left", "right", "value", "gain"))) for _, t in got.groupby("tree")]
        return cls(head["kind"], list(head["features"]), head["start"], trees, np.array(head["importance"]))


def probability_column(models: dict[int, TreeModel] | TreeModel, fold: str | None = None) -> Column:
    """The probability of class 1 by a model, or by the model of a row's fold."""
    by = models if isinstance(models, dict) else {0: models}
    features = next(iter(by.values())).features

    @F.pandas_udf("double")
    def score(x: pd.Series, k: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        m, k, out = np.stack(x.to_numpy()).astype(np.float64), k.to_numpy(), np.zeros(len(x))
        for one in np.unique(k):
            out[k == one] = by[one].probability(m[k == one])
        return pd.Series(out)

    return score(F.array(*[F.col(c).cast("double") for c in features]), F.col(fold).cast("int") if fold else F.lit(0))


def class_counts(rows: DataFrame, label: str, fold: str | None = None) -> dict[tuple[int, int], int]:
    """Rows by (fold, class); one row each comes to the driver."""
    got = rows.groupBy((F.col(fold) if fold else F.lit(-1)).cast("int").alias("f"), F.col(label).cast("int").alias("c")).count().collect()
    return {(r["f"], r["c"]): r["count"] for r in got}
